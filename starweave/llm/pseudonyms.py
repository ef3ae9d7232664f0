"""Format-preserving Feistel pseudonyms for personal numbers and dates, in SQL functions only.

Values are found by shape and checked: card numbers (13 to 19 digits, Luhn), telephone numbers (a + and 10 to 15
digits, or ten as ``(nnn) nnn-nnnn``), IPv4 addresses (octets up to 255), social security numbers (valid areas, groups and serials), calendar dates
1900 to 2099 (ISO, and day.month.year or day/month/year). Each kind and length is a domain of ``a * b`` values; a
value is a pair (l, r) below (a, b), and ``ROUNDS`` rounds add a keyed SHA-256 of one half to the other, modulo a and
b by turns. That is a permutation of the domain with any a and b, so a value keeps its format, equal values get equal
pseudonyms in all documents, different ones different, and ``inverse`` undoes it with the key. A card's check digit is
computed anew, so cards stay valid; a telephone number keeps its country code, which its first digits tell, and a trunk zero in
brackets, so a number has one pseudonym in any notation; dates stay inside 1900 to 2099; separators stay. Mail addresses are no
numbers: their local part becomes a keyed hash, the domain stays.

Defined cases: a null text stays null, an empty one empty, with no findings; numbers that fail their check stay as
they are; texts are read whole; repeated rows are changed alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days from 1900-01-01 to 2099-12-31.
DAYS = 73_049
#: The least product of two like factors that holds them; the two numbers above are walked past.
DAY_FACTORS = (229, 319)

# The country codes of telephone numbers, by their length; all others have three digits.
COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

# The shapes.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)++",
    "phone": r"[+][0-9]{1,3}[ .-]?(?:[(][0-9]{1,4}[)][ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
             r"|[(][0-9]{3}[)] ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1(?:19|20)[0-9]{2})(?![0-9/-]|[.][0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?![0-9]|[.][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9]|-[0-9])|(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9]|-[0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])",
}
KINDS = tuple(SHAPES)
#: The date shape's back reference is to the only group of the joined pattern.
PATTERN = "|".join(SHAPES[k] for k in KINDS)


#: Stands for a trunk zero in brackets, which is not dialled from abroad, while digits are changed.
TRUNK = "(\x01)"


def _hash(key: str, kind: Column, n: Column, turn: Column, value: Column) -> Column:
    """48 bits of a keyed SHA-256."""
    said = F.concat_ws("|", F.lit(key), kind, n.cast("string"), turn.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 12), 16, 10).cast("long")


def feistel(key: str, kind: Column, n: Column, value: Column, a: Column, b: Column, inverse: bool = False) -> Column:
    """``value`` below a * b permuted (or permuted back)."""
    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, b).cast("long").alias("r"))
    sign = -1 if inverse else 1

    def turn(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]
        return F.when(i % 2 == 0, F.struct(F.pmod(l + sign * F.pmod(_hash(key, kind, n, i, r), a), a).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), F.pmod(r + sign * F.pmod(_hash(key, kind, n, i, l), b), b).alias("r")))

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, start, turn, lambda s: s["l"] * b + s["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right (the last included) doubled."""
    places = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(places, lambda c, i: F.when(i % 2 == 0, 2 * c.cast("int")
                       - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))),
                       F.lit(0), lambda s, x: s + x)


def _number(key: str, kind: str, digits: Column, inverse: bool) -> Column:
    """A digit string permuted among those of its length (up to 18 digits)."""
    n = F.length(digits)
    low = F.ceil(n / 2).cast("int")
    a, b = F.pow(F.lit(10.0), n - low).cast("long"), F.pow(F.lit(10.0), low).cast("long")
    return F.lpad(feistel(key, F.lit(kind), n, digits.cast("long"), a, b, inverse).cast("string"), n, "0")


def _fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
                        (s["at"] + F.when(digit, 1).otherwise(0)).alias("at"))

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def kind_of(value: Column) -> Column:
    """The kind of a found value, null if it fails its check."""
    digits = _digits(value)
    octets = F.transform(F.split(value, "[.]"), lambda o: o.cast("int"))
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    last = F.substr(digits, F.length(digits), F.lit(1)).cast("int")
    return (F.when(value.rlike("@"), "email")
            .when(value.startswith("+"), F.when(F.length(digits).between(10, 15), "phone"))
            .when(value.startswith("("), F.when(F.length(digits) == 10, "phone"))
            .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}([./])[0-9]{2}\1[0-9]{4}$"), F.when(_day(value).isNotNull(), "date"))
            .when(value.rlike("^[0-9]{1,3}([.][0-9]{1,3}){3}$"), F.when(F.forall(octets, lambda o: o <= 255), "ip"))
            .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
                  F.when(~value.rlike("^(000|666|9)|-00-|-0000$"), "ssn"))
            .when(F.length(digits).between(13, 19) & (F.pmod(_luhn_sum(body) + last, F.lit(10)) == 0), "card"))


def _day(value: Column) -> Column:
    """Days since 1900-01-01 of a date in one of the formats, null if there is no such day."""
    iso = F.when(value.rlike("^[0-9]{4}"), value).otherwise(
        F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
    return F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.lit("1900-01-01").cast("date"))


def pseudonym(value: Column, kind: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of a checked value (or the value of a pseudonym); others as they are."""
    digits = _digits(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    card = _number(key, "card", body, inverse)
    card = F.concat(card, F.pmod(10 - F.pmod(_luhn_sum(card), F.lit(10)), F.lit(10)).cast("string"))
    dialled = F.replace(value, F.lit("(0)"), F.lit(TRUNK))
    called = _digits(dialled)
    code = F.when(value.startswith("("), "").otherwise(F.regexp_extract(called, COUNTRY, 0))
    phone = F.concat(code, _number(key, "phone", F.substr(called, F.length(code) + 1), inverse))
    phone = F.replace(_fill(dialled, phone), F.lit(TRUNK), F.lit("(0)"))
    octets = F.split(value, "[.]")
    ip = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o.cast("long"))
    half = F.lit(65536).cast("long")
    ip = feistel(key, F.lit("ip"), F.lit(4), ip, half, half, inverse)
    dotted = F.concat_ws(".", *(F.pmod(F.shiftright(ip, 24 - 8 * i), F.lit(256)).cast("string") for i in range(4)))
    a, b = (F.lit(f).cast("long") for f in DAY_FACTORS)
    # on from a number that is no day, to the next that is
    number = F.aggregate(
        F.sequence(F.lit(0), F.lit(DAY_FACTORS[0] * DAY_FACTORS[1] - DAYS)), _day(value).cast("long"),
        lambda n, i: F.when((i > 0) & (n < DAYS), n).otherwise(feistel(key, F.lit("date"), F.lit(8), n, a, b, inverse)))
    day = F.date_add(F.lit("1900-01-01").cast("date"), number.cast("int"))
    iso = F.date_format(day, "yyyy-MM-dd")
    part = F.substring(value, 3, 1)
    date = F.when(value.rlike("^[0-9]{4}"), iso).otherwise(F.concat(
        F.substring(iso, 9, 2), part, F.substring(iso, 6, 2), part, F.substring(iso, 1, 4)))
    at = F.instr(value, "@")
    mail = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lower(value)), 256), 1, 16), F.substr(value, at))
    return (F.when(kind == "card", _fill(value, card)).when(kind == "phone", phone).when(kind == "ip", dotted)
            .when(kind == "date", date).when(kind == "ssn", _fill(value, _number(key, "ssn", digits, inverse)))
            .when(kind == "email", value if inverse else mail).otherwise(value))


def _is(kind: str):
    return lambda k: k == kind


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """(doc_id, text, n_email, n_phone, n_date, n_ip, n_ssn, n_card): the whole texts of ``docs`` with pseudonyms."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # texts without a digit or an @ are not searched
    hit = F.col("text").rlike("[0-9@]")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("values", F.when(hit, F.regexp_extract_all("text", F.lit(f"({PATTERN.replace(chr(92) + '1', chr(92) + '2')})"), F.lit(1))).otherwise(none))
    found = rows.withColumn("found", F.transform("values", lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind"))))
    kinds = F.transform("found", lambda x: x["kind"])
    counts = {f"n_{k}": F.size(F.filter(F.coalesce(kinds, none), _is(k))) for k in KINDS}
    gaps = F.split("text", PATTERN, -1)
    new = F.transform("found", lambda x: pseudonym(x["v"], x["kind"], key, inverse))
    merged = F.array_join(F.flatten(F.zip_with(gaps, new, lambda g, v: F.array(g, F.coalesce(v, F.lit(""))))), "")
    text = F.when(F.exists("found", lambda x: x["kind"].isNotNull()), merged).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"), *(c.cast("int").alias(n) for n, c in counts.items()))
