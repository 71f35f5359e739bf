"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Card numbers, telephone numbers, e-mail and network addresses, dates and access tokens are found by pattern, numbers are validated, and
each value is permuted within its own format by a keyed Feistel network. Equal values get equal pseudonyms everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Kinds in the order in which they are tried at one place of a text.
PATTERNS = {
    # tried at the start of a run only, and a run is not given back: linear in runs without an @
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "token": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?(?:[ -]?[0-9]{2,4}){2,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])",
    "day": r"(?<![0-9A-Za-z./-])(?:"
    + "|".join(rf"[0-9]{{1,2}}{x}[0-9]{{1,2}}{x}(?:19|20)[0-9]{{2}}|(?:19|20)[0-9]{{2}}{x}[0-9]{{1,2}}{x}[0-9]{{1,2}}" for x in ("/", r"\.", "-"))
    + r")(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "national": r"(?<![0-9A-Za-z.+/-])(?:(?:1[ -])?(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}|(?:1[ .])?(?:\([0-9]{3}\) ?|[2-9][0-9]{2}[ .])[0-9]{3}[ .][0-9]{4}"
    r"|\(0[0-9]{1,4}\) ?[0-9]{3,8}(?:[ -][0-9]{1,5})?|0[1-9](?:[ .-][0-9]{2}){4}|0[1-9][0-9]{1,4}[ /-][0-9]{4,8})(?![0-9]|[ ./-][0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(PATTERNS.values())


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def feistel(left: Column, right: Column, wide: tuple[Column, Column], key: Column, kind: str) -> Column:
    """A keyed permutation of (left below wide[0], right below wide[1]), as a struct (a, b) of the permuted halves.

    Each round adds to one half a keyed digest of the other; the rounds are a fold, so that a half is computed once.
    """

    def turned(state: Column, turn: Column) -> Column:
        modulus = F.when(turn % 2 == 0, wide[0]).otherwise(wide[1])
        told = F.sha2(F.concat_ws("|", key, F.lit(kind), wide[0].cast("string"), turn.cast("string"), state["b"].cast("string")), 256)
        return F.struct(state["b"].alias("a"), F.pmod(state["a"] + F.conv(F.substring(told, 1, 12), 16, 10).cast("long"), modulus).alias("b"))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turned)


def permuted(number: Column, size: Column, key: Column, kind: str) -> Column:
    """A decimal string of ``size`` digits (2 to 30) under a keyed permutation of all such strings."""
    half = F.floor(size / 2).cast("int")
    wide = (F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), size - half).cast("long"))
    left, right = F.substring(number, F.lit(1), half), F.substring(number, half + 1, size - half)
    done = F.transform(F.array(feistel(left, right, wide, key, kind)), lambda s: F.concat(F.lpad(s["a"].cast("string"), half, "0"), F.lpad(s["b"].cast("string"), size - half, "0")))
    return done[0]


def luhn_sum(number: Column, doubled_from_end: int) -> Column:
    """Luhn sum of a digit string; every second digit counts double, starting at the given place from the end."""
    places = F.transform(F.split(F.reverse(number), ""), lambda d, i: d.try_cast("int") * F.when(i % 2 == doubled_from_end, 2).otherwise(1))
    return F.aggregate(places, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(F.coalesce(d, F.lit(0))))


def refilled(value: Column, number: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``number``; all else stays."""
    chars = F.split(value, "")
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    done = F.aggregate(
        chars, state,
        lambda s, c: F.when(
            c.between("0", "9"), F.struct(F.concat(s["out"], F.substring(number, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return done["out"]


def lettered(value: Column, key: Column, kind: str, *alphabets: str) -> Column:
    """The characters of each of ``alphabets`` in ``value`` permuted in place by a keyed network of two halves; others stay."""
    size = F.length(value)
    half = F.floor(size / 2).cast("int")

    def turned(state: Column, turn: Column) -> Column:
        told = lambda i: F.sha2(F.concat_ws("|", key, F.lit(kind), size.cast("string"), turn.cast("string"), state["b"], F.floor(i / 16).cast("string")), 256)

        def moved(c: Column, i: Column) -> Column:
            shift = F.conv(F.substring(told(i), ((i % 16) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
            out = c
            for alphabet in alphabets:
                place = F.instr(F.lit(alphabet), c)
                # half of a single character is empty, and stays so
                out = F.when((place > 0) & (c != ""), F.substring(F.lit(alphabet), F.pmod(place - 1 + shift, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
            return out

        return F.struct(state["b"].alias("a"), F.array_join(F.transform(F.split(state["a"], ""), moved), "").alias("b"))

    start = F.struct(F.substring(value, F.lit(1), half).alias("a"), F.substring(value, half + 1, size - half).alias("b"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(3)), start, turned)
    return F.transform(F.array(done), lambda s: F.concat(s["a"], s["b"]))[0]


def card(value: Column, key: Column) -> Column:
    """All digits but the last are permuted and the last is made to fit; a number that fails its check stays."""
    number = digits(value)
    size = F.length(number)
    body = permuted(F.substring(number, F.lit(1), size - 1), size - 1, key, "card")
    full = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(10 - luhn_sum(b, 0) % 10, F.lit(10)).cast("string")))[0]
    return F.when(luhn_sum(number, 1) % 10 == 0, refilled(value, full)).otherwise(value)


def address(value: Column, key: Column) -> Column:
    """The four octets as one number of 32 bits; values with an octet above 255 stay."""
    octets = F.transform(F.split(value, r"\."), lambda o: o.try_cast("long"))
    half = F.lit(65536).cast("long")
    done = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], (half, half), key, "ip")
    quarters = lambda s: F.concat_ws(".", *[f(s[h] / 256) if f is F.floor else s[h] % 256 for h in ("a", "b") for f in (F.floor, None)])
    return F.when(F.exists(octets, lambda o: o > 255), value).otherwise(F.transform(F.array(done), quarters)[0])


def date(value: Column, key: Column) -> Column:
    """Days from 1900-01-01 on in a grid of 269 by 271, which ends in October 2099; later days and no days stay."""
    first = F.lit("1900-01-01").cast("date")
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), first)
    done = feistel(F.floor(day / 271), day % 271, (F.lit(269).cast("long"), F.lit(271).cast("long")), key, "date")
    shown = F.transform(F.array(done), lambda s: F.date_format(F.date_add(first, (s["a"] * 271 + s["b"]).cast("int")), "yyyy-MM-dd"))[0]
    return F.when(day.isNull() | (day >= 269 * 271), value).otherwise(shown)


def day(value: Column, key: Column) -> Column:
    """Dates in other forms than the standard one, permuted as that and written in their own form; no days stay.

    The year may come first. Else the day comes first before a point, or if the first number is above 12; the month does otherwise, unless the second is.
    Numbers below ten have a leading zero as long as both numbers of the value have two digits.
    """
    parts = F.split(value, "[./-]")
    sign = F.regexp_extract(value, "[./-]", 0)
    year_first = F.length(parts[0]) == 4
    one, two = F.when(year_first, parts[1]).otherwise(parts[0]), F.when(year_first, parts[2]).otherwise(parts[1])
    day_first = ~year_first & ((sign == ".") | (one.try_cast("int") > 12) | ((sign == "-") & (two.try_cast("int") <= 12)))
    month, dom = F.when(day_first, two).otherwise(one), F.when(day_first, one).otherwise(two)
    year = F.when(year_first, parts[0]).otherwise(parts[2])
    full = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(dom, 2, "0"))
    wide = (F.length(one) == 2) & (F.length(two) == 2)

    def written(shown: Column) -> Column:
        short = lambda c: F.when(wide, c).otherwise(F.regexp_replace(c, "^0", ""))
        y, m, d = F.substring(shown, 1, 4), short(F.substring(shown, 6, 2)), short(F.substring(shown, 9, 2))
        return F.when(year_first, F.concat_ws("-", y, m, d)).when(day_first, F.concat_ws("-", d, m, y)).otherwise(F.concat_ws("-", m, d, y))

    done = F.transform(F.array(date(full, key)), lambda shown: F.when(shown == full, value).otherwise(F.replace(written(shown), F.lit("-"), sign)))[0]
    return F.when(F.try_to_date(full, "yyyy-MM-dd").isNull(), value).otherwise(done)


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of a found value, or the value itself where it does not validate."""
    is_kind = lambda kind: value.rlike(f"^(?:{PATTERNS[kind]})$")
    at = F.instr(value, "@")
    user = lettered(F.substring(value, F.lit(1), at - 1), key, "email", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    number = digits(value)
    return (
        F.when(at > 0, F.concat(user, F.substring(value, at, F.length(value))))
        .when(is_kind("ip"), address(value, key))
        .when(is_kind("date"), date(value, key))
        .when(is_kind("day"), day(value, key))
        .when(is_kind("phone") | is_kind("ssn") | is_kind("national"), refilled(value, permuted(number, F.length(number), key, "phone")))
        .when(is_kind("card"), card(value, key))
        .when(value.rlike("[a-f]"), lettered(value, key, "token", "0123456789abcdef"))
        .otherwise(lettered(value, key, "token", "0123456789ABCDEF"))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; ``count`` names one more column, how many values changed.

    Null texts stay null, and texts without such values, of any length, stay as they are. Only valid numbers (Luhn), octets and dates are
    replaced. Digits, separators, case and length of a value stay, and so does the host of an address. Rows that repeat are treated alike, other columns
    stay, and an empty table gives an empty result.
    """
    text, secret = F.col(text_col), F.lit(key)
    values = F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(0))
    fresh = F.transform(values, lambda v: pseudonym(v, secret))
    between = F.split(text, ANY, -1)
    rebuilt = F.array_join(F.zip_with(between, fresh, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    some = text.rlike("[0-9@]") & text.rlike(ANY)
    parts = {text_col: F.when(some, rebuilt).otherwise(text)}
    if count:
        parts[count] = F.when(some, F.size(F.filter(F.zip_with(values, fresh, lambda a, b: a != b), lambda x: x))).otherwise(0).cast("int")
    return docs.withColumns(parts)
