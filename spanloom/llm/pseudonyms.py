"""Format-preserving Feistel pseudonyms, all in DataFrame functions.

A text is split around candidate values; each candidate that validates is
permuted inside its own format by a keyed Feistel network and the pieces are
joined again, so the rest of the text keeps every character. The permutation
depends on the key and the value alone: equal values stay equal in every
document, different values of one format stay different, and no table of values
or shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.native import let

ROUNDS = 10
#: Symbols in each half of a Feistel block: 36**11 < 2**63.
HALF = 11

#: Alphabets of the permuted characters.
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"

#: Candidate patterns, the most specific first. Runs of open length
#: are possessive, so the matcher neither recurses nor goes back over them.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9A-Za-z.])\d{1,3}(?:\.\d{1,3}){3}(?![0-9A-Za-z]|\.\d)"
DATE = r"(?<![0-9A-Za-z/.-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?=T\d{2}:)|(?![0-9A-Za-z/-]|\.\d))"
PHONE = r"(?<![0-9A-Za-z+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+\d{1,3}(?:[ -]?\d{2,4}){2,5}(?![0-9A-Za-z])"
SOCIAL = r"(?<![0-9A-Za-z-])\d{3}-\d{2}-\d{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?![0-9A-Za-z]|-\d)"
KINDS = (("email", EMAIL), ("secret", SECRET), ("date", DATE), ("address", ADDRESS), ("social", SOCIAL), ("card", CARD), ("phone", PHONE))
ANY = "|".join(f"(?:{pattern})" for _, pattern in KINDS)

#: Dates from 1900-01-01 to 2099-12-31: 73049 = 319 * 229 days.
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1900-01-01", 319, 229


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: Column) -> Column:
    """A keyed permutation of ``[0, left_size) x [0, right_size)`` as a struct."""

    def mixed(half: Column, r: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", key, r.cast("string"), half.cast("string")), 256), 1, 15), 16, 10).cast("long")

    def step(state: Column, r: Column) -> Column:
        return F.when(
            r % 2 == 0,
            F.struct(F.pmod(state["a"] + F.pmod(mixed(state["b"], r), left_size), left_size).alias("a"), state["b"].alias("b")),
        ).otherwise(F.struct(state["a"].alias("a"), F.pmod(state["b"] + F.pmod(mixed(state["a"], r), right_size), right_size).alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("a"), right.cast("long").alias("b")), step)


def permute_format(value: Column, key: Column, *, alphabet: str | None = None) -> Column:
    """Permute letters and digits of ``value`` within their places.

    Digits stay digits, letters stay letters of the same case, anything else
    stays itself. With ``alphabet`` (lower case) every one of its characters is
    permuted within it. Values longer than two halves go in blocks, each keyed
    by the characters of the block before it, which keeps the whole map a
    permutation and the work in proportion to the length.
    """

    def place(ch: Column) -> Column:
        low = F.lower(ch)
        if alphabet:
            at = F.instr(F.lit(alphabet), low)
            return F.struct(F.when(at > 0, at - 1).otherwise(0).cast("long").alias("at"), F.when(at > 0, len(alphabet)).otherwise(1).cast("long").alias("size"), F.lit(alphabet).alias("of"), (low != ch).alias("upper"), ch.alias("ch"))
        digit, letter = F.instr(F.lit(DIGITS), low), F.instr(F.lit(LETTERS), low)
        return F.struct(
            F.when(digit > 0, digit - 1).when(letter > 0, letter - 1).otherwise(0).cast("long").alias("at"),
            F.when(digit > 0, 10).when(letter > 0, 26).otherwise(1).cast("long").alias("size"),
            F.when(digit > 0, DIGITS).otherwise(LETTERS).alias("of"),
            (low != ch).alias("upper"),
            ch.alias("ch"),
        )

    def number(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda n, x: n * x["size"] + x["at"])

    def size(part: Column) -> Column:
        return F.aggregate(part, F.lit(1).cast("long"), lambda n, x: n * x["size"])

    def written(n: Column, part: Column) -> Column:
        def put(state: Column, x: Column) -> Column:
            symbol = F.substring(x["of"], (F.pmod(state["n"], x["size"]) + 1).cast("int"), F.lit(1))
            drawn = F.when(x["size"] == 1, x["ch"]).otherwise(F.when(x["upper"], F.upper(symbol)).otherwise(symbol))
            return F.struct(F.floor((state["n"] - F.pmod(state["n"], x["size"])) / x["size"]).cast("long").alias("n"), F.concat(drawn, state["out"]).alias("out"))

        return F.aggregate(F.reverse(part), F.struct(n.alias("n"), F.lit("").alias("out")), put)["out"]

    def block(part: Column, tweak: Column) -> Column:
        first = F.floor(F.size(part) / 2).cast("int")
        return let(
            F.struct(F.slice(part, F.lit(1), first).alias("l"), F.slice(part, first + 1, F.size(part)).alias("r")),
            lambda h: let(
                feistel(number(h["l"]), number(h["r"]), size(h["l"]), size(h["r"]), tweak),
                lambda s: F.concat(written(s["a"], h["l"]), written(s["b"], h["r"])),
            ),
        )

    def plain(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda x: x["ch"]), "")

    def blocks(places: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(places), F.lit(1)), F.lit(2 * HALF))
        cut = F.transform(starts, lambda i: F.slice(places, i, F.lit(2 * HALF)))
        return let(cut, lambda parts: F.array_join(F.transform(parts, lambda part, i: block(part, F.concat_ws("|", key, F.when(i > 0, plain(F.get(parts, i - 1))).otherwise("")))), ""))

    return let(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), place), blocks)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the rightmost digit counting once."""

    def weight(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(F.when(n > 4, 2 * n - 9).otherwise(2 * n))

    return F.aggregate(F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), weight), F.lit(0), lambda a, b: a + b)


def _card(value: Column, key: Column) -> Column:
    """Permuted payload with the check digit worked out again; separators stay."""
    digits = F.regexp_replace(value, "[^0-9]", "")

    def renewed(bare: Column) -> Column:
        payload = permute_format(F.substring(bare, F.lit(1), F.length(bare) - 1), F.concat(key, F.lit("|card")))
        return let(payload, lambda p: F.concat(p, F.pmod(10 - F.pmod(luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))

    def laid_out(new: Column) -> Column:
        chars = F.filter(F.split(value, ""), lambda c: c != "")
        put = F.aggregate(
            chars,
            F.struct(F.lit(1).alias("i"), F.lit("").alias("out")),
            lambda s, c: F.when(c.between("0", "9"), F.struct((s["i"] + 1).alias("i"), F.concat(s["out"], F.substring(new, s["i"], F.lit(1))).alias("out"))).otherwise(F.struct(s["i"].alias("i"), F.concat(s["out"], c).alias("out"))),
        )
        return put["out"]

    return let(digits, lambda bare: F.when((luhn_sum(bare) % 10 == 0) & ~bare.rlike("^(.)\\1*$"), let(renewed(bare), laid_out)).otherwise(value))


def _address(value: Column, key: Column) -> Column:
    """Each octet stays within the values of its length; with leading zeros or
    over 255 the value is no address and stays."""
    parts = F.transform(F.split(value, "\\."), lambda x: x.cast("int"))

    def low(octet: Column) -> Column:
        return F.when(octet < 10, 0).when(octet < 100, 10).otherwise(100)

    def size(octet: Column) -> Column:
        return F.when(octet < 10, 10).when(octet < 100, 90).otherwise(156).cast("long")

    def renewed(p: Column) -> Column:
        o = [F.get(p, i) for i in range(4)]
        pair = lambda a, b: (a - low(a)) * size(b) + b - low(b)
        drawn = feistel(pair(o[0], o[1]), pair(o[2], o[3]), size(o[0]) * size(o[1]), size(o[2]) * size(o[3]), F.concat(key, F.lit("|address")))
        high = lambda n, a, b: (low(a) + F.floor(n / size(b))).cast("string")
        rest = lambda n, b: (low(b) + F.pmod(n, size(b))).cast("string")
        return let(drawn, lambda s: F.concat_ws(".", high(s["a"], o[0], o[1]), rest(s["a"], o[1]), high(s["b"], o[2], o[3]), rest(s["b"], o[3])))

    valid = F.forall(parts, lambda x: x < 256) & ~value.rlike(r"(?:^|\.)0\d")
    return F.when(valid, let(parts, renewed)).otherwise(value)


#: Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
AREAS, GROUPS, SERIALS, NO_AREA = 898, 99, 9999, 666


def _social(value: Column, key: Column) -> Column:
    """Permuted among the numbers that can be given; others stay."""
    area, group, serial = (F.substring(value, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))

    def laid_out(s: Column) -> Column:
        new = s["a"] + F.when(s["a"] + 1 >= NO_AREA, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"), F.lpad((F.floor(s["b"] / SERIALS) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(s["b"], F.lit(SERIALS)) + 1).cast("string"), 4, "0"))

    left = area - F.when(area > NO_AREA, 2).otherwise(1)
    drawn = feistel(left, (group - 1) * SERIALS + serial - 1, F.lit(AREAS), F.lit(GROUPS * SERIALS), F.concat(key, F.lit("|social")))
    return F.when(area.between(1, 899) & (area != NO_AREA) & (group > 0) & (serial > 0), let(drawn, laid_out)).otherwise(value)


#: Draws of a day-first date until the day is over 12 (19 or so in 31 are).
WALK = 64


def _date(value: Column, key: Column) -> Column:
    """Year-first values are Y M D, dotted ones D.M.Y, slashed ones M/D/Y or, where
    that is impossible, D/M/Y, whose day stays over 12. Parts of one digit make a
    layout without leading zeros. Impossible dates and other years stay."""
    numbers = F.transform(F.split(value, "[-/.]"), lambda x: x.cast("int"))

    def day(year: Column, month: Column, number: Column) -> Column:
        return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(number.cast("string"), 2, "0")).try_cast("date")

    def draw(n: Column) -> Column:
        drawn = feistel(F.floor(n / DAYS_LOW), F.pmod(n, F.lit(DAYS_LOW)), F.lit(DAYS_HIGH), F.lit(DAYS_LOW), F.concat(key, F.lit("|date")))
        return let(drawn, lambda s: (s["a"] * DAYS_LOW + s["b"]).cast("int"))

    first = F.lit(FIRST_DAY).cast("date")

    def walked(n: Column) -> Column:
        """Draws on until the day is over 12: a permutation of such dates."""
        again = lambda at, _: F.when(F.dayofmonth(F.date_add(first, at)) > 12, at).otherwise(draw(at))
        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), draw(n), again)

    def renewed(p: Column) -> Column:
        a, b, c = (F.get(p, i) for i in range(3))
        year_first, dotted = value.rlike("^\\d{4}"), value.contains(".")
        months_first = day(c, a, b)
        read = F.when(year_first, day(a, b, c)).when(dotted, day(c, b, a)).otherwise(F.coalesce(months_first, day(c, b, a)))
        day_first = ~year_first & ~dotted & months_first.isNull()
        short = value.rlike(r"(?:^|[-/.])\d(?:[-/.]|$)")

        def styled(d: Column) -> Column:
            gap = F.when(value.contains("/"), "/").when(dotted, ".").otherwise("-")
            year = F.lpad(F.year(d).cast("string"), 4, "0")
            month, number = (F.when(short, n.cast("string")).otherwise(F.lpad(n.cast("string"), 2, "0")) for n in (F.month(d), F.dayofmonth(d)))
            laid_out = lambda *parts: F.concat(parts[0], gap, parts[1], gap, parts[2])
            return F.when(year_first, laid_out(year, month, number)).when(dotted | day_first, laid_out(number, month, year)).otherwise(laid_out(month, number, year))

        def kept_in_range(n: Column) -> Column:
            new = F.when(day_first, walked(n)).otherwise(draw(n))
            return F.when(n.between(0, DAYS_HIGH * DAYS_LOW - 1), let(F.date_add(first, new), styled))

        return let(F.datediff(read, first), kept_in_range)

    return F.coalesce(let(numbers, renewed), value)


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of one candidate; itself where it does not validate."""
    full = {kind: value.rlike(f"^(?:{pattern})$") for kind, pattern in KINDS}
    local = F.substring_index(value, "@", 1)
    country = F.regexp_extract(value, r"^(\+\d{1,3}(?=[ .(-]))?", 0)
    return (
        F.when(value.contains("@"), F.concat(permute_format(local, F.concat(key, F.lit("|email"))), F.substring(value, F.length(local) + 1, F.length(value))))
        .when(full["secret"], let(permute_format(F.lower(value), F.concat(key, F.lit("|secret")), alphabet=HEX), lambda p: F.when(value == F.lower(value), p).otherwise(F.upper(p))))
        .when(full["date"], _date(value, key))
        .when(full["address"], _address(value, key))
        .when(full["social"], _social(value, key))
        .when(full["card"], _card(value, key))
        .when(F.regexp_count(value, F.lit("[0-9]")).between(7, 15), F.concat(country, permute_format(F.substring(value, F.length(country) + 1, F.length(value)), F.concat(key, F.lit("|phone")))))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, *, key: str, text: str = "text") -> DataFrame:
    """The input with ``text`` pseudonymised and ``n_replaced`` (long) added.

    Validated values: e-mail addresses, hexadecimal secrets of 32 digits or more,
    card numbers with a right check digit, IPv4 addresses, calendar dates from
    1900 to 2099, social-security numbers that can be given, telephone numbers of
    7 to 15 digits. Everything else stays as it is. A null text stays null
    with 0 replaced, an empty one stays empty; other columns, repeated rows and
    their order are untouched. An input column ``n_replaced`` is replaced.
    """
    secret = F.lit(key)
    found = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))

    def rewritten(values: Column) -> Column:
        between = F.split(F.col(text), ANY, -1)
        new = F.transform(values, lambda v: pseudonym(v, secret))
        return let(
            new,
            lambda drawn: F.struct(
                F.array_join(let(between, lambda gaps: F.transform(gaps, lambda s, i: F.concat(s, F.coalesce(F.get(drawn, i), F.lit(""))))), "").alias("text"),
                F.size(F.filter(F.zip_with(values, drawn, lambda a, b: a != b), lambda x: x)).cast("long").alias("n"),
            ),
        )

    unchanged = F.struct(F.col(text).alias("text"), F.lit(0).cast("long").alias("n"))
    work = F.when(F.col(text).rlike("[0-9@]"), let(found, lambda values: F.when(F.size(values) > 0, rewritten(values)).otherwise(unchanged))).otherwise(unchanged)
    held = "__pseudonymised"
    out = docs.withColumn(held, work)
    columns = [F.col(f"{held}.text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != "n_replaced"]
    return out.select(*columns, F.col(f"{held}.n").alias("n_replaced"))
