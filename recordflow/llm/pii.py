"""Personal data and secrets, replaced by keyed surrogates.

One pattern finds e-mail addresses, secrets, account, card and social-security numbers, IP
addresses, phone numbers and names after a title, outside of longer words. Each is replaced
by a surrogate of its own type: letters by letters and digits by digits of the same script and
case, separators and lengths kept; country codes, card networks and check sums (valid or not, of
cards and accounts) kept; names by names of the title's gender and the name's script; addresses in reserved
domains and networks.

Surrogates are keyed: SHA-256 of key, type, plain form and round. The plain form (lower case,
letters and digits only where separators are free) is the same for all spellings of one entity, so they get one surrogate
in each spelling's format, in all documents. Names are entities part by part: a surname has one
surrogate after any title, a first name one for its gender. A collision check keeps entities apart: of
entities with one surrogate the first keeps it, nobody gets a surrogate that is itself found in
the texts, and the others try again with the next round's hash until all have one. Where the
format has no room for all, surrogates grow: local parts from the second round on, digits and
secrets from round ``GROWN_FROM``; addresses of four numbers move to the IPv6 documentation
network. Each round has a larger space, so the rounds end whatever the number of entities.

Columns and SQL functions only. Texts without a find go through unread by any join. For the
others only ids and finds are exploded; finds are made distinct before surrogates are made, so
one address in a third of all documents is one row a task. A document's surrogates come back
to it in one map, as large as its own finds.

Defined cases: null texts stay null, empty ones empty; a text without finds stays as it is.
Repeated rows and ids are each replaced alike. Other columns stay, of any name. An empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name

KEY = "surrogates"
GROWN_FROM, MOST_ADDED = 8, 30

# Titles before names, by gender.
TITLES = {
    "male": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н"),
    "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа"),
    "any": ("Dr", "Prof"),
}
# First names by script and gender, and syllables of last names by script.
FIRST = {
    "latin": {"male": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Simon", "Victor", "Walter"),
              "female": ("Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora", "Olga", "Sarah", "Vera")},
    "cyrillic": {"male": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Олег"),
                 "female": ("Алла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга")},
}
SYLLABLES = {
    "latin": ("bar", "bel", "cor", "dan", "del", "far", "gol", "han", "kel", "lan", "lor", "mar", "mil", "nor", "pel", "ran", "ser", "tan", "ver", "win"),
    "cyrillic": ("бар", "бел", "вол", "гор", "дан", "жар", "зор", "кал", "лан", "мор", "нел", "рад", "сол", "тар"),
}

# Country codes of one and two digits; all others have three.
CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

_END = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_NAME = r"(?:\p{Lu}['’])?+\p{Lu}\p{L}++(?:[-'’]\p{Lu}\p{L}++){0,2}+"
# Each begins where no letter or digit stands before. The case of letters is free in titles only.
PATTERNS = {
    "email": r"(?<![._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": r"(?:[0-9A-Fa-f]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9]{20,}+)" + _END
              + r"|(?<=(?i:token|secret|password|passwd|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']{0,1})[A-Za-z0-9+/_-]{8,}+",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ip": rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}" + r"(?![\p{L}\p{N}]|\.\d)" + r"|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}" + _END
          + r"|(?<!:)(?=[0-9A-Fa-f:]{0,39}\d)(?:(?:[0-9A-Fa-f]{1,4}:){1,6}|:):[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}(?![\p{L}\p{N}:])",
    "ssn": r"\d{3}-\d{2}-\d{4}" + _END,
    "phone": r"(?<!\+)(?:\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ /-]\d{5,8})" + _END,
    "card": r"(?<!\.)\d(?:[ -]?\d){12,18}" + _END,
    "person": rf"(?iu:{_TITLES})\.? {_NAME}(?: {_NAME}){{0,2}}+",
}
# One look behind for all: inside a word, which is nearly everywhere, nothing else is tried.
PATTERN = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"


def found(text: Column) -> Column:
    """The finds of a text, in order. Null texts have none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))


def kind_of(find: Column) -> Column:
    kind = F.lit("secret")
    order = [k for k in PATTERNS if k != "secret"]
    for name in reversed(order):
        kind = F.when(find.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def _plain(kind: Column, find: Column) -> Column:
    """What all spellings of an entity have in common."""
    name = F.lower(F.regexp_replace(find, rf"^(?iu:{_TITLES})\.? ", ""))
    # the country code of a number is part of it as written, and not drawn anew
    number = F.regexp_replace(find, r"[^\p{N}+]", "")
    number = F.regexp_replace(number, rf"^\+({CODES}|\d{{3}})(?=\d)", "+$1:")
    return F.when(kind == "person", F.concat(_gender(find), F.lit(":"), name)).when(kind == "phone", number).when(
        kind.isin("email", "secret") | ((kind == "ip") & find.contains(".")), F.lower(find)).otherwise(F.lower(F.regexp_replace(find, r"[^\p{L}\p{N}]", "")))


def _written(kind: Column, plain: Column) -> Column:
    """What of a plain form the texts show: a first name without its gender."""
    return F.when(kind == "given", F.substring_index(plain, ":", -1)).otherwise(plain)


def _name_parts(known: DataFrame) -> DataFrame:
    """``find, place, kind, plain`` of the names of persons: the last is a surname, which is the same
    after any title, those before it are first names with the gender that a title gives them. After a
    title for any gender, a first name has the gender that it has elsewhere, if that is one."""
    name, gender = F.substring_index("plain", ":", -1), F.substring_index("plain", ":", 1)
    parts = known.where("kind = 'person'").select(
        "find", gender.alias("gender"), F.split(name, " ").alias("names")).select(
        "find", "gender", F.size("names").alias("n"), F.posexplode("names").alias("place", "name"))
    told = parts.where("place < n - 1 and gender <> 'any'").groupBy(F.col("name").alias("told_name")).agg(
        F.min("gender").alias("told"), F.max("gender").alias("other")).where("told = other").drop("other")
    met = parts.join(told, F.col("name") == F.col("told_name"), "left")
    known_gender = F.coalesce(F.when(F.col("gender") != "any", F.col("gender")), "told", F.lit("any"))
    surname = F.col("place") == F.col("n") - 1
    return met.select(
        "find", "place", F.when(surname, "surname").otherwise("given").alias("kind"),
        F.when(surname, F.col("name")).otherwise(F.concat_ws(":", known_gender, "name")).alias("plain"))


def _letters(text: Column) -> Column:
    return F.split(text, "(?s)(?<=.)(?=.)")


def _gender(find: Column) -> Column:
    def titled(kind: str) -> Column:
        return find.rlike(rf"^(?iu:{'|'.join(TITLES[kind])})\.? ")

    return F.when(titled("male"), "male").when(titled("female"), "female").otherwise("any")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is put together once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _digits_of(stream: Column, i: Column, size: int) -> Column:
    """A number below ``size`` from byte i of the hash."""
    return F.pmod(F.conv(F.get(stream, i), 16, 10).try_cast("int"), F.lit(size))


def _pick(choices, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), n + 1)


def _characters(plain: Column, stream: Column, hexes: Column, shift: int = 0) -> Column:
    """Each letter or digit replaced by one of its sort."""
    def one(c: Column, place: Column) -> Column:
        i = place + shift
        letter = F.when(hexes, F.lit("abcdef").substr(_digits_of(stream, i, 6) + 1, F.lit(1))).otherwise(
            F.lit("abcdefghijklmnopqrstuvwxyz").substr(_digits_of(stream, i, 26) + 1, F.lit(1)))
        cyrillic = F.lit("абвгдежзиклмнопрстуфхцчшэюя").substr(_digits_of(stream, i, 27) + 1, F.lit(1))
        return F.when(c.rlike(r"\d"), _digits_of(stream, i, 10).cast("string")).when(
            c.rlike(r"\p{IsCyrillic}"), cyrillic).when(c.rlike(r"\p{L}|\p{N}"), letter).otherwise(c)

    return F.array_join(F.transform(_letters(plain), one), "")


def _luhn(digits: Column) -> Column:
    """The check sum of a digit string, modulo 10."""
    n = F.length(digits)
    values = F.transform(_letters(digits), lambda c, i: F.when(
        (n - i) % 2 == 1, c.try_cast("int")).otherwise(_pick((0, 2, 4, 6, 8, 1, 3, 5, 7, 9), c.try_cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10


def _mod_97(letters_and_digits: Column) -> Column:
    """An account number modulo 97, letters counting from 10 on."""
    values = F.transform(_letters(letters_and_digits), lambda c: F.when(
        c.rlike(r"\d"), c.try_cast("int")).otherwise(F.ascii(c) - 87))
    return F.aggregate(values, F.lit(0), lambda a, x: F.pmod(a * F.when(x > 9, 100).otherwise(10) + x, F.lit(97)))


def _account(plain: Column, stream: Column, more: Column) -> Column:
    """The country stays, the rest is drawn, and the check digits are as right or wrong as they were."""
    country = plain.substr(1, 2)
    body = F.concat(_characters(plain.substr(F.lit(5), F.length(plain)), stream, F.lit(False)), more)

    def whole(body: Column) -> Column:
        was = _mod_97(F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(1, 4)))
        check = F.pmod(was - _mod_97(F.concat(body, country, F.lit("00"))), F.lit(97))
        return F.concat(country, F.lpad((check + F.when(check < 2, 97).otherwise(0)).cast("string"), 2, "0"), body)

    return _bound(body, whole)


def _surrogate(kind: Column, plain: Column, key: str, turn: int) -> Column:
    """The surrogate's plain form, from the keyed hash of this turn."""
    # a random byte for each character, at least 64 of them: blocks of 32
    blocks = F.transform(F.sequence(F.lit(0), (F.length(plain) / 32).cast("int") + 1), lambda b: F.sha2(
        F.concat_ws("|", F.lit(key), kind, F.md5(plain), F.lit(str(turn)), b.cast("string")), 256))
    stream = F.regexp_extract_all(F.array_join(blocks, ""), F.lit("[0-9a-f]{2}"), F.lit(0))
    return _bound(stream, lambda s: _formed(kind, plain, s, turn))


def _added(alphabet: str, plain: Column, stream: Column, n: int) -> Column:
    """``n`` more characters, from bytes that no character of the plain form uses."""
    return F.concat(F.lit(""), *[F.lit(alphabet).substr(
        _digits_of(stream, F.length(plain) + i, len(alphabet)) + 1, F.lit(1)) for i in range(n)])


def _formed(kind: Column, plain: Column, stream: Column, turn: int) -> Column:
    hexes = plain.rlike("^[0-9a-f]*$")
    code = F.regexp_extract(plain, r"^\+\d+:", 0)
    phone = _bound(plain.substr(F.length(code) + 1, F.length(plain)), lambda p: _characters(p, stream, F.lit(False)))
    more = _added("0123456789", plain, stream, min(MOST_ADDED, 3 * max(0, turn - GROWN_FROM + 1)))
    digits = F.concat(_bound(hexes, lambda h: _characters(plain, stream, h)), more)
    local, domain = F.substring_index(plain, "@", 1), _pick(("com", "net", "org"), _digits_of(stream, F.lit(40), 3))
    longer = _added("abcdefghijklmnopqrstuvwxyz", plain, stream, min(MOST_ADDED, 4 + 2 * turn) if turn else 0)
    email = F.concat(_characters(local, stream, F.lit(False)), longer, F.lit("@example."), domain)
    octets = [(240 + _digits_of(stream, F.lit(0), 15)).cast("string"), *[
        _digits_of(stream, F.lit(i), 254).cast("string") for i in (1, 2, 3)]]
    groups = [F.concat(F.get(stream, F.lit(i)), F.get(stream, F.lit(i + 1))) for i in range(4, 16, 2)]
    four = F.concat_ws(".", *octets) if turn < GROWN_FROM else F.concat_ws(":", F.lit("2001:db8"), *groups)
    ip = F.when(plain.rlike(r"^\d+(\.\d+){3}$"), four).otherwise(digits)
    off = F.concat(plain.substr(F.lit(1), F.lit(1)), _characters(
        plain.substr(F.lit(2), F.length(plain) - 2), stream, F.lit(False), 1), more)
    check = F.pmod(_luhn(plain) - _luhn(F.concat(off, F.lit("0"))), F.lit(10))
    card = F.concat(off, check.cast("string"))
    gender = F.substring_index(plain, ":", 1)
    given = surname = F.lit(None).cast("string")
    for script in ("latin", "cyrillic"):
        def first(g: str, names=FIRST[script]) -> Column:
            return _pick(names[g], _digits_of(stream, F.lit(1), len(names[g])))

        def syllables(begin: int, end: int, some=SYLLABLES[script]) -> Column:
            return F.concat(F.lit(""), *[_pick(some, _digits_of(stream, F.lit(i), len(some))) for i in range(begin, end)])

        mine = plain.rlike(r"\p{IsCyrillic}") == F.lit(script == "cyrillic")
        drawn = F.when(gender == "male", first("male")).when(gender == "female", first("female")).otherwise(
            F.when(_digits_of(stream, F.lit(0), 2) == 0, first("male")).otherwise(first("female")))
        given = F.when(mine, F.concat_ws(":", gender, F.lower(F.concat(drawn, syllables(2, 2 + min(turn, 12)))))).otherwise(given)
        surname = F.when(mine, syllables(2, 6 + min(turn, 8))).otherwise(surname)
    account = _account(plain, stream, more)
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "iban", account).when(
        kind == "given", given).when(kind == "surname", surname).when(kind == "phone", F.concat(code, phone, more)).otherwise(digits)


def _spelt(kind: Column, find: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of a find: its separators and case, character by character."""
    upper = (F.upper(find) == find) & (F.lower(find) != find)
    email = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    title = F.regexp_extract(find, rf"^((?iu:{_TITLES})\.? )", 1)
    bare = F.regexp_replace(find, rf"^(?iu:{_TITLES})\.? ", "")
    name = F.initcap(surrogate)
    person = F.concat(title, F.when(F.upper(bare) == bare, F.upper(name)).otherwise(name))
    ip = F.when(find.contains("."), surrogate)
    # secrets are spelt in one way; of the others, which are short, separators are passed over
    places = F.when(kind != "secret", F.filter(
        F.transform(_letters(find), lambda c, i: F.when(c.rlike(r"\p{L}|\p{N}"), i)), lambda i: i.isNotNull()))

    def spelt(known: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            at = F.when(kind == "secret", i).otherwise(F.array_position(known["places"], i).cast("int") - 1)
            new = F.get(known["new"], at)
            return F.when((kind != "secret") & ~c.rlike(r"\p{L}|\p{N}"), c).when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)

        # a surrogate that has grown ends with what it has more
        own = F.when(kind == "secret", F.length(find)).otherwise(F.size(known["places"]))
        return F.concat(F.array_join(F.transform(_letters(find), one), ""), F.array_join(
            F.slice(known["new"], own + 1, F.greatest(F.size(known["new"]) - own, F.lit(0))), ""))

    drawn = F.when(kind == "phone", F.regexp_replace(surrogate, "[+:]", "")).otherwise(surrogate)
    others = _bound(F.struct(_letters(drawn).alias("new"), places.alias("places")), spelt)
    return F.when(kind == "email", email).when(kind == "person", person).when(
        kind == "ip", F.coalesce(ip, others)).otherwise(others)


def surrogates(finds: DataFrame, key: str = KEY) -> DataFrame:
    """``find, kind, surrogate`` for a frame with the distinct column ``find``."""
    known = finds.withColumn("kind", kind_of(F.col("find"))).withColumn("plain", _plain(F.col("kind"), F.col("find")))
    known = cut(known)
    names = cut(_name_parts(known))
    left = known.where("kind <> 'person'").select("kind", "plain").union(names.select("kind", "plain")).distinct()
    # surrogates are compared as the texts will show them, with one another and with what is there
    taken = left.select("kind", _written(F.col("kind"), F.col("plain")).alias("shown")).distinct()
    done: list[DataFrame] = []
    for turn in count():
        tried = left.withColumn("new", _surrogate(F.col("kind"), F.col("plain"), key, turn))
        tried = tried.withColumn("shown", _written(F.col("kind"), F.col("new")))
        first = tried.groupBy("kind", "shown").agg(F.min(F.struct("plain", "new")).alias("best"))
        won = first.join(taken, ["kind", "shown"], "left_anti")
        if done:
            won = won.join(reduce(DataFrame.union, done).select("kind", "shown"), ["kind", "shown"], "left_anti")
        won = cut(won.select("kind", "best.plain", "best.new", "shown"))
        done.append(won)
        left = cut(left.join(won, ["kind", "plain"], "left_anti"))
        if left.isEmpty():
            break
    new = reduce(DataFrame.union, done)
    # a find has as many names as the pattern lets it have
    persons = names.join(new, ["kind", "plain"]).groupBy("find").agg(
        F.array_sort(F.collect_list(F.struct("place", "shown"))).alias("names")).select(
        "find", F.lit("person").alias("kind"), F.array_join(F.col("names.shown"), " ").alias("new"))
    others = known.where("kind <> 'person'").join(new, ["kind", "plain"]).select("find", "kind", "new")
    return others.union(persons).select(
        "find", "kind", _spelt(F.col("kind"), F.col("find"), F.col("new")).alias("surrogate"))


def replaced(df: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``df`` with surrogates in its texts, and ``n_found``, how many finds were replaced (a
    column of that name is replaced)."""
    texts, names = F.col(f"`{text}`"), [c for c in df.columns if c.lower() != "n_found"]
    own, ident, key_name, new_name = (free_name(df, x) for x in ("own_finds", "find_key", "map_key", "new_by_find"))
    looked = df.select(*[F.col(f"`{c}`") for c in names], found(texts).alias(own))
    without = looked.where(F.coalesce(F.size(own), F.lit(0)) <= 0).drop(own).withColumn("n_found", F.lit(0))
    having = looked.where(F.size(own) > 0).withColumn(ident, F.sha2(texts, 256))
    pairs = cut(having.select(F.col(ident).alias("key"), F.explode(F.array_distinct(own)).alias("find")).distinct())
    made = surrogates(pairs.select("find").distinct(), key)
    maps = pairs.join(made, "find").groupBy(F.col("key").alias(key_name)).agg(
        F.map_from_entries(F.collect_list(F.struct("find", "surrogate"))).alias(new_name))
    joined = having.join(maps, F.col(ident) == F.col(key_name))
    gaps = F.split(texts, PATTERN, -1)
    new = F.concat(F.transform(own, lambda f: F.element_at(new_name, f)), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(gaps, new, lambda a, b: F.concat(a, b)), "")
    columns = [whole.alias(c) if c == text else F.col(f"`{c}`") for c in names]
    return joined.select(*columns, F.size(own).alias("n_found")).unionByName(without)
