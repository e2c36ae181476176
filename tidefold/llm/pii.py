"""Personal data and secrets become format-preserving pseudonyms; DataFrame and SQL functions only.

E-mail addresses, access keys and named secrets of any length are found by their form alone.  Numbers are tried at every
place where one can begin, from left to right: IPv4 addresses with valid octets, dates of the calendar, national numbers
outside the reserved groups, IBANs of their country's length with remainder 97, card numbers by the Luhn check, and
telephone numbers by their number of digits; where a longer reading is not valid, shorter ones that end with a group of
digits are tried.  A valid value is replaced by a keyed Feistel permutation inside its own format: equal values get
equal pseudonyms in all documents, different values different ones, and without the key there is no way back.

The network has ROUNDS rounds.  A value is a row of places, each with its alphabet (digits, small letters, capitals,
hexadecimal digits; other characters stand alone and stay).  Each round adds to the places of one half, modulo their
alphabets, a key stream made by SHA-512 of the key, the kind, the round, the other half and, for long values, the number
of each block of places, so the rounds can be undone by whoever has the key.  Numbers are permuted without their
separators, so that a number is linked however it is written.  Card numbers keep their first digit and get their check
digit anew; IBANs keep the country and get check digits anew; telephone numbers keep a separate country code; addresses
are permuted as 32 bits, dates as days from 1900 to 2099 (by cycle walking).  E-mail addresses keep their domain.

Defined results: null texts stay null; texts without valid values, and numbers that fail validation, stay as they
are; of values that begin at one place the first kind of the list above counts, and of values that overlap the first
one; a value of one place is shifted by a constant; equal rows get equal results; other columns, whatever their names,
are kept; an empty table stays one.  No pattern recurses with the text's length, so texts may be of any length.  Every
step is narrow: there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Only for tests and examples; callers give their own secret.
SAMPLE_KEY = "sample key"

DIGITS = "0123456789"
SMALL = "abcdefghijklmnopqrstuvwxyz"
CAPITAL = SMALL.upper()

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]+\.[A-Za-z0-9-]*[A-Za-z])[A-Za-z0-9.-]*[A-Za-z]"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?i:AKIA|ASIA)[A-Za-z0-9]{16}(?![A-Za-z0-9])"
NAME = r"(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
SECRET = rf"(?<![A-Za-z]){NAME}[A-Za-z0-9+/_.~!?#$%^*@=:|\\-]{{8,}}+"
#: Valid as soon as they match; where one begins, the first of them counts.
NAMED = "|".join((EMAIL, ACCESS_KEY, SECRET))

IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])"
NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
#: The lengths of IBANs and the countries that have them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = "(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"
#: Card numbers in the usual groups, then of 19 to 13 digits that end with a group.
CARDS = ("(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])", "(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])", *(f"(?<![0-9])[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])" for n in range(19, 12, -1)))
#: Telephone numbers with a country code and four to two further groups, then two national forms.
#: Groups do not begin where an IPv4 address does.
PHONES = (*(rf"(?<![0-9+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?(?!{IPV4})[0-9]{{2,4}}){{{n}}}(?![0-9])" for n in (4, 3, 2)), r"(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9])", r"(?<![0-9+])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])")
#: Where a number can begin.
BEGIN = r"(?=(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}|(?<![0-9])[0-9]|(?<![0-9+])\+[0-9]|\([0-9])"
#: Pieces between such places that a value can have at most, and characters.
MOST_PIECES, MOST_CHARS = 24, 140
#: What texts with a value have: four digits in a row of digits and separators, an at sign or one of the words.
NUMBERS = r"[0-9](?:[ ./()+-]{0,3}[0-9]){3}"
HINT = rf"{NUMBERS}|@|(?i:password|passwd|secret|token|api[_-]?key|akia|asia)"


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.split(s, "")).otherwise(F.array().cast("array<string>"))


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


BLOCK = 32


def _stream(key: str, kind: str, round_: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}\x00{kind}\x00"), round_.cast("string"), F.lit(":"), half), 512)


def _streams(key: str, kind: str, round_: Column, half: Column, places: Column) -> Column:
    """The key stream by blocks of BLOCK numbers, as many as the places need."""
    seed = _stream(key, kind, round_, half)
    more = lambda first: F.transform(F.sequence(F.lit(0), F.floor((places - 1) / BLOCK).cast("int")), lambda b: F.when(b == 0, first).otherwise(F.sha2(F.concat(first, F.lit(":"), b.cast("string")), 512)))
    return _let(seed, more)


def _number(streams: Column, i: Column) -> Column:
    """Of the key stream: the i-th number of 16 bits."""
    return F.conv(F.substring(F.element_at(streams, F.floor(i / BLOCK).cast("int") + 1), 1 + 4 * (i % BLOCK), F.lit(4)), 16, 10).cast("int")


def permuted(s: Column, key: str, kind: str, one_alphabet: Column | None = None) -> Column:
    """The pseudonym of ``s``, place for place; ``one_alphabet`` is used for all places in it if given."""

    def alphabet(c: Column) -> Column:
        own = F.when(c.rlike("^[0-9]$"), DIGITS).when(c.rlike("^[a-z]$"), SMALL).when(c.rlike("^[A-Z]$"), CAPITAL).otherwise(c)
        return own if one_alphabet is None else F.when(one_alphabet.isNotNull() & (F.instr(one_alphabet, c) > 0), one_alphabet).otherwise(own)

    def on(alphabets: Column) -> Column:
        half = F.floor(F.size(alphabets) / 2).cast("int")
        values = F.transform(_chars(s), lambda c, i: F.instr(F.element_at(alphabets, i + 1), c) - 1)

        def play(v: Column, r: Column) -> Column:
            left = r % 2 == 0  # the half that is changed
            other = F.array_join(F.when(left, F.slice(v, half + 1, F.size(v))).otherwise(F.slice(v, 1, half)).cast("array<string>"), ",")
            changed = lambda streams: F.transform(v, lambda x, i: F.when((i < half) == left, (x + _number(streams, i)) % F.length(F.element_at(alphabets, i + 1))).otherwise(x))
            return _let(_streams(key, kind, r, other, F.size(alphabets)), changed)

        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, play)
        return F.array_join(F.transform(done, lambda x, i: F.substring(F.element_at(alphabets, i + 1), x + 1, F.lit(1))), "")

    return F.when(F.length(s) > 0, _let(F.transform(_chars(s), alphabet), on)).otherwise(s)


def permuted_number(n: Column, key: str, kind: str, low: int, high: int, size: int) -> Column:
    """A permutation of 0 .. size - 1, with low * high >= size, by cycle walking over pairs below (low, high)."""

    def play(p: Column, r: Column) -> Column:
        stream = lambda half: F.conv(F.substring(_stream(key, kind, r, half.cast("string")), 1, 12), 16, 10).cast("bigint")
        return F.when(r % 2 == 0, F.struct(((p["a"] + stream(p["b"])) % low).alias("a"), p["b"].alias("b"))).otherwise(F.struct(p["a"].alias("a"), ((p["b"] + stream(p["a"])) % high).alias("b")))

    def walk(x: Column, step: Column) -> Column:
        pair = F.struct(F.floor(x / high).cast("bigint").alias("a"), (x % high).cast("bigint").alias("b"))
        once = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, play, lambda p: p["a"] * high + p["b"])
        return F.when((step > 0) & (x < size), x).otherwise(once)

    steps = 1 if low * high == size else 12
    return F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), n.cast("bigint"), walk)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a number with its check digit in the last place."""
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, x: a + x)


def remainder_97(iban: Column) -> Column:
    """Of a compact IBAN, its country and check digits moved to the end, letters read as 10 to 35."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    return F.aggregate(_chars(turned), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.conv(c, 36, 10).cast("int")) % 97).otherwise((a * 100 + F.conv(c, 36, 10).cast("int")) % 97))


def _refill(template: Column, pattern: str, letters: Column) -> Column:
    """The template with its characters of ``pattern`` replaced, in order, by ``letters``."""
    step = lambda a, c: F.when(c.rlike(pattern), F.struct(F.concat(a["s"], F.substring(letters, a["n"], F.lit(1))).alias("s"), (a["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["n"].alias("n")))
    return F.aggregate(_chars(template), F.struct(F.lit("").alias("s"), F.lit(1).alias("n")), step, lambda a: a["s"])


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    body = F.concat(F.substring(digits, 1, 1), permuted(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card"))
    checked = _let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return _let(checked, lambda c: _refill(m, "[0-9]", c))


def _iban(m: Column, key: str) -> Column:
    compact = F.replace(m, F.lit(" "), F.lit(""))
    body = permuted(F.substring(compact, F.lit(5), F.length(compact)), key, "iban")
    country = F.substring(compact, 1, 2)
    checked = _let(body, lambda b: F.concat(country, F.lpad((98 - remainder_97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))
    return _let(checked, lambda c: _refill(m, "[A-Z0-9]", c))


def _ipv4(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.")
    n = F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.cast("bigint"))
    octet = lambda x, k: (F.shiftright(x, k).bitwiseAND(F.lit(255))).cast("string")
    return _let(permuted_number(n, key, "ipv4", 1 << 16, 1 << 16, 1 << 32), lambda x: F.concat_ws(".", octet(x, 24), octet(x, 16), octet(x, 8), octet(x, 0)))


def _date(m: Column, key: str) -> tuple[Column, Column]:
    """Whether the date is in the calendar, and its pseudonym."""
    first, second = F.substring(m, 1, 2).cast("int"), F.substring(m, 4, 2).cast("int")
    iso = m.rlike("^[0-9]{4}-")
    month_first = m.contains("/") & (first <= 12)
    year = F.when(iso, F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4)).cast("int")
    month = F.when(iso, F.substring(m, 6, 2).cast("int")).when(month_first, first).otherwise(second)
    day = F.when(iso, F.substring(m, 9, 2).cast("int")).when(month_first, second).otherwise(first)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    valid = year.between(1900, 2099) & month.between(1, 12) & (day >= 1) & (day <= last)
    start = F.to_date(F.lit("1900-01-01"))
    number = F.datediff(F.make_date(year, month, day), start)
    layout = lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(m.contains("."), F.date_format(d, "dd.MM.yyyy")).when(month_first, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    return valid, _let(F.date_add(start, permuted_number(number, key, "date", 270, 271, 73049).cast("int")), layout)


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, r"^(\+[0-9]{1,3}(?=[ .(-])|\+)?(.*)$", 1)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return _let(permuted(_digits(rest), key, "phone"), lambda d: F.concat(code, _refill(rest, "[0-9]", d)))


def named_pseudonym(m: Column, key: str) -> Column:
    """A struct of the kind and the pseudonym of a match of NAMED."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    name = F.regexp_extract(m, f"^({NAME})", 1)
    value = F.substring(m, F.length(name) + 1, F.length(m))
    hexadecimal = F.when(value.rlike("^[0-9a-f]+$"), DIGITS + "abcdef").when(value.rlike("^[0-9A-F]+$"), DIGITS + "ABCDEF")
    made = lambda kind, new: F.struct(F.lit(kind).alias("kind"), new.alias("value"))
    email = made("email", F.concat(permuted(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1)))
    access = made("access_key", F.concat(F.substring(m, 1, 4), permuted(F.substring(m, F.lit(5), F.length(m)), key, "access_key")))
    return F.when(whole(EMAIL), email).when(whole(ACCESS_KEY), access).otherwise(made("secret", F.concat(name, _let(F.struct(value.alias("s"), hexadecimal.alias("h")), lambda v: permuted(v["s"], key, "secret", v["h"])))))


def number_at(s: Column) -> Column:
    """The value that begins with the second character of ``s`` (the first is what stands before it): a struct of its
    kind and its characters, or null."""
    at = lambda p: F.regexp_extract(s, f"(?s)^.({p})", 1)
    octets = lambda m: F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)
    in_calendar = lambda m: _date(m, "")[0]
    not_reserved = lambda m: ~m.rlike("^(?:000|666|9..)-|-00-|-0000$")
    iban = lambda m: remainder_97(F.replace(m, F.lit(" "), F.lit(""))) == 1
    luhn = lambda m: (luhn_sum(_digits(m)) % 10 == 0) & ~m.rlike("^[0 -]+$")
    long_enough = lambda m: F.length(_digits(m)).between(10, 15)
    tests = [("ipv4", IPV4, octets), ("date", DATE, in_calendar), ("national", NATIONAL, not_reserved), ("iban", IBAN, iban), *(("card", p, luhn) for p in CARDS), *(("phone", p, long_enough) for p in PHONES)]

    def tried(kind: str, pattern: str, valid) -> Column:
        return _let(at(pattern), lambda m: F.when(F.when(m != "", valid(m)).otherwise(False), F.struct(F.lit(kind).alias("kind"), m.alias("m"))))

    return F.coalesce(*(tried(*x) for x in tests))


def number_pseudonym(kind: Column, m: Column, key: str) -> Column:
    national = lambda: _let(permuted(_digits(m), key, "national"), lambda d: _refill(m, "[0-9]", d))
    return F.when(kind == "ipv4", _ipv4(m, key)).when(kind == "date", _date(m, key)[1]).when(kind == "national", national()).when(kind == "iban", _iban(m, key)).when(kind == "card", _card(m, key)).otherwise(_phone(m, key))


def _apart(df: DataFrame, name: str, value: Column, *sources: str) -> DataFrame:
    """``df`` with a column that is computed once, in a step of its own: every source is named twice, so that the
    optimizer does not put them into one another, as nested functions on arrays take long to plan."""
    there = F.lit(True)
    for c in sources:
        there = there & (F.size(c) >= 0)
    return df.withColumn(name, F.when(there, value))


def pseudonymise(documents: DataFrame, key: str, *, text: str = "text", kinds: str | None = None) -> DataFrame:
    """``documents`` with the values in ``text`` replaced; ``kinds`` names a column to add: the kinds of the replaced
    values, one for each, in their order.  Columns keep their order; a column named ``kinds`` is replaced.

    All steps work on arrays of a text: its parts between named values, their pieces from one place where a number can
    begin to the next, what is ahead of each such place, and the value there.
    """
    names = documents.columns
    t = F.col(f"`{text}`")
    nothing = F.array().cast("array<string>")
    each = lambda c, f: F.transform(c, lambda part, g: F.transform(part, lambda x, i: f(x, i, g)))
    df = documents.withColumn("_tf_gaps", F.when(t.rlike(HINT), F.split(t, NAMED, -1)))
    df = df.withColumn("_tf_named", F.when(F.col("_tf_gaps").isNotNull(), F.regexp_extract_all(t, F.lit(NAMED), F.lit(0))))
    df = _apart(df, "_tf_named", F.transform("_tf_named", lambda m: named_pseudonym(m, key)), "_tf_named")
    df = _apart(df, "_tf_pieces", F.transform("_tf_gaps", lambda g: F.when(g.rlike(NUMBERS), F.split(g, BEGIN, -1)).otherwise(F.array(g))), "_tf_gaps")

    def ahead(x: Column, i: Column, g: Column) -> Column:
        pieces = F.get("_tf_pieces", g)
        before = F.when(i > 0, F.substring(F.get(pieces, i - 1), -1, 1)).otherwise("\n")
        return F.when(x.rlike("^[0-9+(A-Z]"), F.concat(before, F.substring(F.array_join(F.slice(pieces, i + 1, F.lit(MOST_PIECES)), ""), 1, MOST_CHARS)))

    df = _apart(df, "_tf_ahead", each("_tf_pieces", ahead), "_tf_pieces")
    df = _apart(df, "_tf_value", each("_tf_ahead", lambda x, i, g: F.when(x.isNotNull(), number_at(x))), "_tf_ahead")

    def placed(v: Column, i: Column, g: Column) -> Column:
        """The value with its first piece (from 1) and the number of pieces that it touches."""
        step = lambda a, y: F.when(a["left"] > 0, F.struct((a["left"] - F.length(y)).alias("left"), (a["n"] + 1).alias("n"))).otherwise(a)
        touched = F.aggregate(F.slice(F.get("_tf_pieces", g), i + 1, F.lit(MOST_PIECES)), F.struct(F.length(v["m"]).alias("left"), F.lit(0).alias("n")), step, lambda a: a["n"])
        return F.when(v.isNotNull(), F.struct((i + 1).alias("at"), touched.alias("n"), v["kind"].alias("kind"), v["m"].alias("m")))

    df = _apart(df, "_tf_value", F.transform(each("_tf_value", placed), lambda part: F.filter(part, lambda v: v.isNotNull())), "_tf_value", "_tf_pieces")
    # of values that overlap, the first: their places, one after the other
    none = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("kept"))
    keep = lambda a, v: F.when(v["at"] > a["end"], F.struct((v["at"] + v["n"] - 1).alias("end"), F.array_append(a["kept"], v["at"]).alias("kept"))).otherwise(a)
    df = _apart(df, "_tf_kept", F.transform("_tf_value", lambda part: F.aggregate(part, none, keep, lambda a: a["kept"])), "_tf_value")
    df = _apart(df, "_tf_value", F.transform("_tf_value", lambda part, g: F.when(F.size(part) == F.size(F.get("_tf_kept", g)), part).otherwise(F.filter(part, lambda v: F.array_contains(F.get("_tf_kept", g), v["at"])))), "_tf_value", "_tf_kept")
    df = _apart(df, "_tf_new", each("_tf_value", lambda v, i, g: number_pseudonym(v["kind"], v["m"], key)), "_tf_value")

    def rebuilt(x: Column, k: Column, g: Column) -> Column:
        """The pieces since the value before, the new value, and the rest of the last piece that it touches."""
        pieces, v = F.get("_tf_pieces", g), F.get(F.get("_tf_value", g), k)
        earlier = F.get(F.get("_tf_value", g), k - 1)
        since = F.when(k > 0, earlier["at"] + earlier["n"]).otherwise(1)
        own = F.array_join(F.slice(pieces, v["at"], v["n"]), "")
        return F.concat(F.array_join(F.slice(pieces, since, v["at"] - since), ""), x, F.substring(own, F.length(v["m"]) + 1, F.length(own)))

    df = _apart(df, "_tf_new", each("_tf_new", rebuilt), "_tf_new", "_tf_value", "_tf_pieces")

    def part(pieces: Column, g: Column) -> Column:
        values = F.get("_tf_value", g)
        last = F.get(values, F.size(values) - 1)
        end = F.when(F.size(values) > 0, F.array_join(F.slice(pieces, last["at"] + last["n"], F.size(pieces)), "")).otherwise(F.array_join(pieces, ""))
        return F.concat(F.array_join(F.get("_tf_new", g), ""), end, F.coalesce(F.get("_tf_named", g)["value"], F.lit("")))

    new = F.when(F.col("_tf_gaps").isNotNull(), F.array_join(F.transform("_tf_pieces", part), "")).otherwise(t)
    of_part = lambda values, g: F.concat(F.transform(values, lambda v: v["kind"]), F.when(F.get("_tf_named", g).isNotNull(), F.array(F.get("_tf_named", g)["kind"])).otherwise(nothing))
    found = F.coalesce(F.flatten(F.transform("_tf_value", of_part)), nothing)
    out = [new.alias(text) if c == text else F.col(f"`{c}`") for c in names if c != kinds]
    return df.select(*out, *([found.alias(kinds)] if kinds else []))
