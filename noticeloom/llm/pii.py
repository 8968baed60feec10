"""Personal data and secrets replaced by surrogates, in DataFrame and SQL functions alone.

Entities are found by one pattern and reduced to a canonical value (digits of a number, a lower-case address, a name's
words), so that mentions of one entity share its surrogate everywhere, however they are written.

What has a format (numbers, addresses, secrets) is turned into symbols, each with the range that its place allows: a digit,
a letter of its script, an octet. A keyed permutation of all values with the same ranges gives the surrogate: it is
one-to-one, so distinct values stay distinct without looking at the corpus, and it moves every value. It is a Feistel
network P between even and odd places, a keyed step in the first symbol, and P undone.

Names have no such range. A surrogate name is drawn from a keyed hash, of syllables of the name's script, with an ending of
the gender that any mention's title tells. Drawn names are checked for collisions: one that is also another name's, or a
name of the corpus, is drawn again, longer. Later mentions of a name without a title are replaced in the same text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: What may stand between a telephone number's groups: a few characters that are neither letters nor digits.
BETWEEN = r"[^\p{L}\p{N}\n]{0,5}"
#: Titles by the gender that they tell.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "г-н", "господин", "κύριος"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "г-жа", "госпожа", "κυρία"), "x": ("Dr", "Prof")}
ANY_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
NAME = r"\p{Lu}\p{Ll}{1,40}+(?:-\p{Lu}\p{Ll}{1,40}+)?"
#: How keys of well-known services begin.
KEY_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza)"
#: The lengths of country codes, one digit, two digits or three.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Loops run over classes of characters or are bounded, since a matcher recurses once for every round of a loop over a group.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++(?<!\.)@(?![.\-])[A-Za-z0-9\-.]{1,253}(?<=[A-Za-z0-9]\.[A-Za-z]{2,24})(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "ip6": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
    # Short ones hold a digit or three groups; names of code such as add::face do not.
    r"|(?<![0-9A-Za-z:.])(?=[A-Fa-f:]{0,40}\d|[A-Fa-f]{1,4}::?[A-Fa-f]{1,4}:)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])",
    "phone": rf"\+\d{{1,3}}{BETWEEN}\(\d{{2,4}}\){BETWEEN}\d{{3,4}}{BETWEEN}\d{{3,4}}(?!\d)|\+\d{{1,3}}(?: ?\(0\) ?\d{{2,4}})?(?:[ .\-]\d{{2,4}}){{2,4}}(?!\d)|\+\d{{9,15}}(?!\d)"
    r"|(?<![\p{L}\p{N}+.\-])(?:1[ .\-])?(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[.\-]\d{4}(?![\p{L}\p{N}\-])",
    "secret": r"(?<![0-9A-Za-z])(?=[A-Fa-f]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    "key": rf"(?<![0-9A-Za-z]){KEY_PREFIX}[0-9A-Za-z_\-]{{16,255}}(?![0-9A-Za-z_\-])",
    "card": r"(?<![0-9A-Za-z])(?:\d{4}(?:[ \-]?\d{4}){3}|3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5})(?![0-9A-Za-z])",
}
PERSON = rf"(?<![\p{{L}}\p{{N}}])(?:{ANY_TITLE})\.? {NAME}(?: {NAME}){{0,2}}(?![\p{{L}}\p{{N}}])"
#: A capitalised word, which can be a later mention of a name.
CAPITALISED = r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}{1,40}+(?:-\p{Lu}\p{Ll}{1,40}+)?(?![\p{L}\p{N}])"
FORMATTED = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every text with a formatted entity holds, and every text with a titled name; most texts without one are told apart by these.
HINT, TITLE_HINT = r"[0-9@]|gh[pousr]_|sk-|xox|AKIA|ASIA|AIza|[A-Fa-f]::?[A-Fa-f]", rf"(?=[{''.join(sorted({t[0] for ts in TITLES.values() for t in ts}))}])(?:{ANY_TITLE})\.? \p{{Lu}}"

#: Runs of code points that take each other's places, by the first and how many: digits and letters by script.
RUNS = (
    (0x30, 10), (0x61, 26), (0x41, 26), (0xE0, 23), (0xF8, 8),  # digits, Latin
    (0x3B1, 25), (0x430, 32), (0x450, 16), (0x561, 38), (0x10D0, 43),  # Greek, Cyrillic, Armenian, Georgian
    (0x5D0, 27), (0x621, 26), (0x641, 10), (0x660, 10), (0x6F0, 10),  # Hebrew, Arabic, its digits
    (0x905, 53), (0x966, 10), (0x995, 20), (0x9E6, 10), (0xE01, 46), (0xE50, 10),  # Devanagari, Bengali, Thai
    (0x3041, 86), (0x30A1, 90), (0x4E00, 20_992), (0xAC00, 11_172),  # kana, Han, Hangul
)
#: Syllables that names are made of, and endings of given names, by script.
SYLLABLES = {
    "latin": ("ba", "ben", "cor", "da", "del", "fa", "gar", "han", "kel", "la", "len", "mar", "mon", "nel", "or", "per", "ran", "sel", "tor", "vin", "wes", "yor"),
    "cyrillic": ("бо", "вер", "гор", "да", "зор", "ка", "ли", "мар", "ни", "ро", "се", "та"),
    "greek": ("βα", "γε", "δη", "κα", "λε", "μα", "νι", "πα", "ρο", "στε"),
    "armenian": ("աբ", "գա", "դի", "կո", "լե", "մա", "նա", "րու", "սա", "տի"),
}
ENDINGS = {
    "latin": {"m": ("o", "us", "an"), "f": ("a", "ia", "ina"), "x": ("e", "is", "y"), "family": ("son", "er", "ley", "man")},
    "cyrillic": {"m": ("ан", "ил"), "f": ("ана", "ила"), "x": ("и", "е"), "family": ("ко", "чук", "енко")},
    "greek": {"m": ("ος", "ης"), "f": ("α", "ία"), "x": ("ι", "ω"), "family": ("ίδης", "άκης", "όπουλος")},
    "armenian": {"m": ("են", "ակ"), "f": ("ուհի", "ինե"), "x": ("ի", "ե"), "family": ("յան", "ունի")},
}
#: First octets of ordinary public addresses; all others say what an address is for and stay.
PUBLIC = [a for a in range(1, 224) if a not in (10, 100, 127, 169, 172, 192, 198, 203)]
#: By first octet, the second octets that belong to a special network.
SPECIAL = {172: (16, 31), 192: (168, 168), 169: (254, 254)}


def has_formatted(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(HINT) & F.col(text).rlike(FORMATTED), F.lit(False))


def has_person(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(TITLE_HINT) & F.col(text).rlike(PERSON), F.lit(False))


def kind_of(mention: Column) -> Column:
    out = F.lit("card")
    for kind in ("phone", "secret", "key", "ip", "ip6", "email"):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, not at every place where body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def turned(values: Column, ranges: Column, key: str, context: Column) -> Column:
    """values (array of int, each from 0 below its number in ranges) moved by the keyed permutation of all arrays with these ranges.

    One-to-one, and no array stays as it is unless no range is above 1. context: what else the values have in common.
    """
    turns = F.array(*(F.lit(t) for t in (1, 2, 3, 4, 0, -4, -3, -2, -1)))

    def run(held: Column) -> Column:
        ranges, context, first = held["ranges"], held["context"], held["first"]

        def step(held: Column, turn: Column) -> Column:
            side = F.abs(turn) % 2
            others = F.array_join(F.transform(held, lambda x, i: F.when(i % 2 != side, x.cast("string"))), ",")
            noise = F.sha2(F.concat_ws("\x1f", F.lit(key), context, F.abs(turn).cast("string"), F.when(turn != 0, others)), 256)

            def moved(h: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    n = F.get(ranges, i).cast("long")
                    drawn = _number(F.substring(F.sha2(F.concat_ws("\x1f", h, i.cast("string")), 256), 1, 12))
                    by = F.when(turn == 0, F.when(i == first, 1 + F.pmod(drawn, n - 1)).otherwise(0)).when(i % 2 == side, F.signum(turn.cast("double")).cast("long") * F.pmod(drawn, n)).otherwise(F.lit(0).cast("long"))
                    return F.pmod(x + by, n).cast("int")

                return F.transform(held, one)

            return _let(noise, moved)

        return F.when(first >= 0, F.aggregate(turns, held["values"], step)).otherwise(held["values"])

    first = lambda n: (F.array_position(F.transform(n, lambda x: x > 1), F.lit(True)) - 1).cast("int")
    told = _let(F.struct(values.alias("values"), ranges.alias("ranges")), lambda h: F.struct(h["values"].alias("values"), h["ranges"].alias("ranges"), F.concat_ws("\x1e", context, F.array_join(h["ranges"], ",")).alias("context"), first(h["ranges"]).alias("first")))
    return _let(told, run)


def _permuted(first: Column, values: Column, ranges: Column, key: str, context: Column) -> Column:
    """The turned values, each counted from its first one again."""
    return F.zip_with(first, turned(values, ranges, key, context), lambda f, v: f + v)


def _like(value: Column, key: str, context: str) -> Column:
    """value with other digits and letters, each of its own run; all else stays."""
    runs = F.expr("array(" + ", ".join(f"struct({first} AS first, {n} AS n)" for first, n in RUNS) + ")")

    def run(code: Column) -> Column:
        found = F.get(F.filter(runs, lambda r: (code >= r["first"]) & (code < r["first"] + r["n"])), F.lit(0))
        return F.coalesce(found, F.struct(code.alias("first"), F.lit(1).alias("n")))

    def made(at: Column) -> Column:
        first = F.transform(at, lambda x: x["run"]["first"])
        out = _permuted(first, F.transform(at, lambda x: x["code"] - x["run"]["first"]), F.transform(at, lambda x: x["run"]["n"]), key, F.lit(context))
        return F.array_join(F.transform(out, lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")), "")

    codes = F.transform(_chars(value), lambda c: F.ascii(c))
    return _let(F.transform(codes, lambda c: F.struct(c.alias("code"), run(c).alias("run"))), made)


def _digits_like(digits: Column, first: Column, ranges: Column, key: str, context: Column) -> Column:
    """digits in their places' ranges; first: the least digit of each."""
    values = F.zip_with(F.transform(_chars(digits), lambda c: c.cast("int")), first, lambda d, f: d - f)
    return F.array_join(_permuted(first, values, ranges, key, context), "")


def luhn(digits: Column) -> Column:
    """The Luhn sum modulo ten; 0 for valid card numbers."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 0, twice).otherwise(d)

    return F.pmod(F.aggregate(F.transform(_chars(digits), worth), F.lit(0), lambda a, d: a + d), F.lit(10))


def _card(value: Column, key: str) -> Column:
    """The issuer's first digits and the Luhn remainder stay."""
    kept = F.when(F.length(value) == 15, 2).otherwise(1)
    middle = F.substring(value, kept + 1, F.length(value) - kept - 1)
    chars = _chars(middle)
    drawn = _digits_like(middle, F.transform(chars, lambda c: F.lit(0)), F.transform(chars, lambda c: F.lit(10)), key, F.lit("card"))

    def checked(front: Column) -> Column:
        missing = F.pmod(luhn(value) - luhn(F.concat(front, F.lit("0"))), F.lit(10))
        return F.concat(front, missing.cast("string"))

    return _let(F.concat(F.substring(value, F.lit(1), kept), drawn), checked)


def _ip(value: Column, key: str) -> Column:
    """Private and special networks stay what they are, and so do a network's first and last address."""
    octets = F.transform(F.split(value, r"\."), lambda c: c.cast("int"))
    public = F.array(*map(F.lit, PUBLIC))

    def made(o: Column) -> Column:
        a, b, d = F.get(o, F.lit(0)), F.get(o, F.lit(1)), F.get(o, F.lit(3))
        lo = hi = F.lit(None).cast("int")
        for octet, (least, most) in SPECIAL.items():
            lo, hi = F.when(a == octet, least).otherwise(lo), F.when(a == octet, most).otherwise(hi)
        wide = F.coalesce(hi - lo + 1, F.lit(0))
        fixed_b = F.coalesce(b.between(lo, hi), F.lit(False))
        at = F.array_position(public, a).cast("int")
        values = F.array(F.when(at > 0, at - 1).otherwise(0), F.when(fixed_b, 0).otherwise(b - F.when(b > hi, wide).otherwise(0)), F.get(o, F.lit(2)), F.when(d.between(1, 254), d - 1).otherwise(0))
        ranges = F.array(F.when(at > 0, len(PUBLIC)).otherwise(1), F.when(fixed_b, 1).otherwise(256 - wide), F.lit(256), F.when(d.between(1, 254), 254).otherwise(1))
        # What stays is part of the context, so that each network has its own permutation.
        context = F.concat_ws(":", F.lit("ip"), F.when(at == 0, a), F.when(fixed_b, b), F.when(~d.between(1, 254), d))

        def written(v: Column) -> Column:
            second = F.get(v, F.lit(1))
            return F.concat_ws(
                ".",
                F.when(at > 0, F.get(public, F.get(v, F.lit(0)))).otherwise(a),
                F.when(fixed_b, b).otherwise(second + F.when(second >= lo, wide).otherwise(0)),
                F.get(v, F.lit(2)),
                F.when(d.between(1, 254), F.get(v, F.lit(3)) + 1).otherwise(d),
            )

        return _let(turned(values, ranges, key, context), written)

    return _let(octets, made)


def _hex(value: Column, key: str, context: str) -> Column:
    """Other hexadecimal digits; all else stays."""

    def made(chars: Column) -> Column:
        is_hex = lambda c: c.rlike("[0-9a-f]")
        values = F.transform(chars, lambda c: F.when(is_hex(c), _number(c).cast("int")).otherwise(0))
        ranges = F.transform(chars, lambda c: F.when(is_hex(c), 16).otherwise(1))
        out = turned(values, ranges, key, F.lit(context))
        return F.array_join(F.zip_with(chars, out, lambda c, v: F.when(is_hex(c), F.lower(F.hex(v))).otherwise(c)), "")

    return _let(_chars(value), made)


def _telephone(digits: Column, country: Column, key: str) -> Column:
    """The national digits. First digits of 2 and more stay so; in ten-digit numbers of country 1, the fictional exchange 555 stays, and others never become it."""

    def made(n: Column) -> Column:
        american = (country == "1") & (F.length(n) == 10)
        fictional = american & (F.substring(n, 4, 3) == "555")
        chars = _chars(n)
        opening = F.substring(n, 1, 1) >= "2"
        first = F.transform(chars, lambda c, i: F.when(fictional & i.between(3, 5), 5).when((i == 0) & opening, 2).otherwise(0))
        ranges = F.transform(chars, lambda c, i: F.when(fictional & i.between(3, 5), 1).when(i == 0, F.when(opening, 8).otherwise(2)).otherwise(10))
        context = F.concat_ws(":", F.lit("phone"), country)
        plain = _digits_like(n, first, ranges, key, context)
        # The exchange as one symbol out of 999.
        rest = F.concat(F.substring(n, 1, 3), F.substring(n, 7, 4))
        exchange = F.substring(n, 4, 3).cast("int")
        values = F.concat(F.array(exchange - (exchange > 555).cast("int")), F.transform(_chars(rest), lambda c, i: c.cast("int") - F.when((i == 0) & opening, 2).otherwise(0)))
        wide = F.concat(F.array(F.lit(999)), F.transform(_chars(rest), lambda c, i: F.when(i == 0, F.when(opening, 8).otherwise(2)).otherwise(10)))

        def written(v: Column) -> Column:
            e = F.get(v, F.lit(0))
            d = F.array_join(F.transform(F.slice(v, 2, 7), lambda x, i: x + F.when((i == 0) & opening, 2).otherwise(0)), "")
            return F.concat(F.substring(d, 1, 3), F.lpad((e + (e >= 555).cast("int")).cast("string"), 3, "0"), F.substring(d, 4, 4))

        other = _let(turned(values, wide, key, context), written)
        return F.when(american & ~fictional, other).otherwise(plain)

    return _let(digits, made)


def _filled(mention: Column, digits: Column) -> Column:
    """The mention with these digits in its digits' places."""

    def fill(a: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        out = F.concat(a["out"], F.when(digit, F.substring(digits, a["i"], F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (a["i"] + digit.cast("int")).alias("i"))

    return F.aggregate(_chars(mention), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), fill)["out"]


def _phone(mention: Column, key: str) -> Column:
    """Country code and national digits tell the number, so one written with and without the code is the same; a trunk (0) is left out."""
    trunk = "(\x01)"
    bare = F.replace(mention, F.lit("(0)"), F.lit(trunk))
    digits = F.regexp_replace(bare, "[^0-9]", "")
    abroad = mention.startswith("+")
    country = F.when(abroad, F.regexp_extract(digits, COUNTRY, 1)).otherwise("1")
    told = F.when(abroad, F.length(country)).otherwise(F.length(digits) - 10)  # digits of the country code in the mention
    national = F.substring(digits, told + 1, F.lit(30))
    new = F.concat(F.substring(digits, F.lit(1), told), _telephone(national, country, key))
    return F.replace(_let(new, lambda d: _filled(bare, d)), F.lit(trunk), F.lit("(0)"))


def _cased(mention: Column, made: Column) -> Column:
    return F.array_join(F.zip_with(_chars(mention), _chars(made), lambda old, new: F.when(old.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)), "")


def _email(mention: Column, key: str) -> Column:
    """The local part and the domain each by themselves: one domain has one surrogate. Its last part, and names reserved for examples, stay."""
    value = F.lower(mention)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    stays = F.regexp_extract(domain, r"((?:\.example)?\.[a-z]+)$", 1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(stays))
    return _let(F.concat(_like(local, key, "mailbox"), F.lit("@"), _like(host, key, "domain"), stays), lambda made: _cased(mention, made))


def _key(mention: Column, key: str) -> Column:
    prefix = F.regexp_extract(mention, f"^({KEY_PREFIX})", 1)
    return F.concat(prefix, _like(F.substring(mention, F.length(prefix) + 1, F.length(mention)), key, "key"))


def _ip6(mention: Column, key: str) -> Column:
    """The first group stays."""
    value = F.lower(mention)
    network = F.substring_index(value, ":", 1)
    rest = F.substring(value, F.length(network) + 1, F.length(value))
    return _let(F.concat(network, _hex(rest, key, "ip6")), lambda made: _cased(mention, made))


def surrogate(mention: Column, key: str) -> Column:
    """What replaces a formatted mention, in the mention's own format: a function of the key and the mention alone."""

    def of(kind: Column) -> Column:
        return (
            F.when(kind == "email", _email(mention, key))
            .when(kind == "ip", _ip(mention, key))
            .when(kind == "ip6", _ip6(mention, key))
            .when(kind == "phone", _phone(mention, key))
            .when(kind == "secret", _let(_hex(F.lower(mention), key, "secret"), lambda made: F.when(mention.rlike("[A-F]"), F.upper(made)).otherwise(made)))
            .when(kind == "key", _key(mention, key))
            .otherwise(_filled(mention, _card(F.regexp_replace(mention, "[^0-9]", ""), key)))
        )

    return _let(kind_of(mention), of)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").when(word.rlike(r"\p{IsArmenian}"), "armenian").when(word.rlike(r"\p{IsLatin}"), "latin").otherwise("other")


def name_parts(mention: Column) -> Column:
    """A titled mention's words: array of role (given or family), gender (m, f, or x if the title does not tell) and value."""
    title = F.regexp_extract(mention, f"^({ANY_TITLE})", 1)
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("x")
    words = _name_words(mention)
    return F.transform(words, lambda w, i: F.struct(_role(words, i).alias("role"), gender.alias("gender"), F.lower(w).alias("value")))


def _name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^(?:{ANY_TITLE})\.? ", ""), " ")


def _role(words: Column, i: Column) -> Column:
    return F.when(i == F.size(words) - 1, "family").otherwise("given")


def _noise(key: str, *what: Column) -> Column:
    """256 bytes of keyed noise as hexadecimal text."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(block)), *what), 256) for block in range(8)])


def _byte(noise: Column, i: Column) -> Column:
    return _number(F.substring(noise, (F.pmod(i, F.lit(256)) * 2 + 1).cast("int"), F.lit(2))).cast("int")


def _name(role: Column, gender: Column, value: Column, noise: Column, attempt: Column) -> Column:
    """Two syllables and an ending of the script and the gender; one more syllable with every second attempt. A name of no script with syllables gets letters of its own."""
    script, count = _script(value), F.least(F.lit(2) + F.floor(attempt / 2).cast("int"), F.lit(200))
    letters = F.array_distinct(_chars(value))
    out = F.array_join(F.transform(F.sequence(F.lit(1), count + 3), lambda i: F.get(letters, F.pmod(_byte(noise, i), F.size(letters)))), "")
    for name, syllables in SYLLABLES.items():
        pool = F.array(*map(F.lit, syllables))
        stem = F.array_join(_stem(pool, len(syllables), count, noise), "")
        for kind, endings in ENDINGS[name].items():
            ending = F.get(F.array(*map(F.lit, endings)), F.pmod(_byte(noise, F.lit(0)), F.lit(len(endings))))
            fits = (script == name) & ((role == "family") if kind == "family" else (role == "given") & (gender == kind))
            out = F.when(fits, F.concat(stem, ending)).otherwise(out)
    return out


def _stem(pool: Column, n: int, count: Column, noise: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.get(pool, F.pmod(_byte(noise, i), F.lit(n))))


def assign(parts: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """role, value, surrogate of all distinct names (role, value, gender): no two of a role share a surrogate, and none is a name itself.

    A given name that titles give both genders, or none, gets an ending for either. A name that collides is drawn again and
    grows by a syllable every second time, so collisions end.
    """
    told = F.collect_set(F.when(F.col("gender") != "x", F.col("gender")))
    names = parts.groupBy("role", "value").agg(told.alias("told")).select("role", "value", F.when(F.size("told") == 1, F.element_at("told", 1)).otherwise("x").alias("gender"))
    drawn, turn = names.withColumn("attempt", F.lit(0)), 0
    while True:
        noise = _noise(key, F.col("role"), F.col("value"), F.col("attempt").cast("string"))
        drawn = drawn.withColumn("surrogate", _let(noise, lambda n: _name(F.col("role"), F.col("gender"), F.col("value"), n, F.col("attempt"))))
        drawn = scratch.keep(drawn, f"drawn{turn}")
        order = F.struct("attempt", F.xxhash64("value"), "value")
        first = drawn.groupBy(F.col("role").alias("t0"), F.col("surrogate").alias("s0")).agg(F.min(order).alias("first"), F.count("*").alias("n"))
        first = first.filter("n > 1").select("t0", "s0", F.col("first.value").alias("owner"))
        real = drawn.select(F.col("value").alias("v1")).distinct()
        judged = drawn.join(first, (F.col("role") == F.col("t0")) & (F.col("surrogate") == F.col("s0")), "left").join(real, F.col("surrogate") == F.col("v1"), "left")
        again = (F.col("owner").isNotNull() & (F.col("owner") != F.col("value"))) | F.col("v1").isNotNull()
        judged = scratch.keep(judged.select("role", "value", "gender", "attempt", "surrogate", again.alias("again")), f"judged{turn}")
        if judged.filter("again").isEmpty():
            return judged.select("role", "value", "surrogate")
        if turn:
            scratch.drop(f"judged{turn - 1}")
        drawn = judged.withColumn("attempt", F.col("attempt") + F.col("again").cast("int")).select("role", "value", "gender", "attempt")
        turn += 1


def _capital(word: Column, like: Column) -> Column:
    """A surrogate name as written: parts between hyphens of the old one do not matter, the first letter is a capital one."""
    return F.when(like.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))).otherwise(word)


def _person(mention: Column, names: Column) -> Column:
    """A titled mention with its words replaced by what names (map of role|value) has for them."""
    title = F.regexp_extract(mention, rf"^((?:{ANY_TITLE})\.? )", 1)
    words = _name_words(mention)
    new = F.transform(words, lambda w, i: F.coalesce(_capital(names[F.concat_ws("|", _role(words, i), F.lower(w))], w), w))
    return F.concat(title, F.array_join(new, " "))


def _mentioned(word: Column, names: Column) -> Column:
    """A capitalised word that is one of the names, replaced; else null."""
    low = F.lower(word)
    return _capital(F.coalesce(names[F.concat(F.lit("family|"), low)], names[F.concat(F.lit("given|"), low)]), word)


def _joined(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """struct of text with each match of pattern replaced by what new makes of it (null: left alone), and how many were replaced."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    swapped = F.transform(found, lambda m: F.struct(m.alias("old"), new(m).alias("new")))

    def made(s: Column) -> Column:
        written = F.concat(F.transform(s, lambda x: F.coalesce(x["new"], x["old"])), F.array(F.lit("")))
        out = F.array_join(F.transform(F.arrays_zip(between.alias("b"), written.alias("n")), lambda x: F.concat(F.coalesce(x["b"], F.lit("")), F.coalesce(x["n"], F.lit("")))), "")
        return F.struct(out.alias("text"), F.size(F.filter(s, lambda x: x["new"].isNotNull())).cast("long").alias("n"))

    return _let(swapped, made)


@lru_cache(maxsize=4)
def _formatted(key: str, application: str) -> Column:
    """_joined of the column text with the surrogates of formatted entities. Kept by application, since it is thousands of calls to build."""
    return _joined(F.col("text"), FORMATTED, lambda m: surrogate(m, key))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with every entity in text replaced, and with the column n_entities (long) added; a column of that name is replaced.

    n_entities counts the mentions that were replaced, later mentions of names among them. Null and empty texts stay as they
    are. Rows alike in doc_id and text get the same text. The key decides all surrogates: those of formatted entities by
    themselves, those of names unless two names of the corpus drew the same one. Texts without a titled name are not shuffled.
    """
    scratch = Scratch(docs.sparkSession)
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(f"({PERSON})"), F.lit(1)))
    named = docs.filter(has_person()).select(F.col("doc_id"), F.xxhash64("text").alias("digest"), F.explode(found).alias("mention"))
    parts = named.select("doc_id", "digest", F.explode(name_parts(F.col("mention"))).alias("part")).select("doc_id", "digest", "part.*").distinct()
    parts = scratch.keep(parts, "parts")
    table = assign(parts.select("role", "value", "gender").distinct(), key, scratch).select(F.col("role").alias("r2"), F.col("value").alias("v2"), "surrogate")
    told = parts.select("doc_id", "digest", "role", "value").distinct().join(table, (F.col("role") == F.col("r2")) & (F.col("value") == F.col("v2")))
    names = told.groupBy(F.col("doc_id").alias("d0"), F.col("digest").alias("g0")).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "role", "value"), "surrogate"))).alias("names"))
    names = scratch.keep(names, "names")
    columns = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col("text").alias("text"), F.col("doc_id").alias("doc_id"))
    formatted = _formatted(key, docs.sparkSession.sparkContext.applicationId)
    as_it_is = F.struct(F.col("text").alias("text"), F.lit(0).cast("long").alias("n"))
    rows = rows.withColumn("person", has_person()).withColumn("made", F.when(has_formatted(), formatted).otherwise(as_it_is))
    alone = rows.filter(~F.col("person")).select("row", "made.text", "made.n")
    of_names = lambda m: F.when(m.rlike(f"^(?:{PERSON})$"), _person(m, F.col("names"))).when(m.rlike(f"^(?:{CAPITALISED})$"), _mentioned(m, F.col("names")))
    people = rows.filter("person").select("row", "doc_id", F.xxhash64("text").alias("digest"), "made")
    people = people.join(names.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d0")) & (F.col("digest") == F.col("g0")))
    people = people.select("row", _joined(F.col("made.text"), f"(?:{PERSON})|(?:{CAPITALISED})", of_names).alias("named"), F.col("made.n").alias("n"))
    people = people.select("row", "named.text", (F.col("named.n") + F.col("n")).alias("n"))
    out = alone.unionByName(people).select("row.*", F.col("text").alias("__text"), F.col("n").alias("__n"))
    return out.select(*(F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in columns), F.col("__n").alias("n_entities"))
