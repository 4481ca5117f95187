"""PII: format-preserving Feistel pseudonyms, with DataFrame functions only.

One pattern finds candidates; each is validated by its kind (checksum, ranges, calendar) and mapped by a keyed
permutation of the kind's own value space, so a pseudonym is valid in the same format, different values stay
different, and equal values stay equal in all documents:

* card: 13 to 19 digits with a right Luhn digit. The payload is permuted, the check digit made anew. Digit strings of
  that length without one are permuted as plain account numbers.
* iban: right by mod 97. The digits of the account part are permuted, country and letters stay, check digits are new.
* ssn: a valid area, group and serial, permuted over the valid ones.
* ipv4: four octets, permuted over all 2**32.
* phone: + and a country code, found by its digits; those after it are permuted over their length, whatever separates
  them, so a number keeps its pseudonym in every notation.
* date: a real day between 1800 and 2199, as yyyy-mm-dd or dd/mm/yyyy, permuted over these 146,097 days.
* email and secret (32 to 64 hexadecimal digits) are no numbers of bounded size: a keyed digest of the same shape.

The permutation is an alternating Feistel network of ROUNDS rounds over two parts with additions modulo the parts'
sizes; round values come from SHA-256 of key, kind, round and the other part. It maps a kind's space onto itself
exactly, without cycle walking.

Nulls: a null text stays null with no finds. Empty and very long texts, ties and repeated rows are ordinary; a find of any
length is matched without recursion, as its only unbounded groups are possessive. Extra columns are dropped. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
#: Patterns of the kinds, in order of preference.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"\+1[ -]?\(?[0-9]{3}\)?[ -]?[0-9]{3}[ -]?[0-9]{4}(?![0-9])|\+[2-9][0-9]{0,2}(?:[ -]?\([0-9]{1,4}\))?(?:[ -]?[0-9]{2,4}){2,4}(?![0-9])",
    "date": r"(?<![0-9/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
}
DAYS_A, DAYS_B = 189, 773  # 146,097 days in 400 years
AREAS = 898  # 001 to 899 without 666
#: Country calling codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = [20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58, 60, 61, 62, 63, 64, 65, 66, 81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98]

_long = lambda c: c.cast("bigint")


def _lit(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _round_value(key: Column, kind: Column, i: Column, other: Column) -> Column:
    """60 bits of a digest."""
    text = F.concat_ws("|", key, kind, i.cast("string"), other.cast("string"))
    return _long(F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 15), 16, 10))


def feistel(key: Column, kind: Column, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """struct(a, b): the permuted pair, a below size_a and b below size_b."""
    start = F.struct(_long(a).alias("a"), _long(b).alias("b"))

    def step(v: Column, i: Column) -> Column:
        even = i % 2 == 0
        new_a = F.when(even, (v["a"] + _round_value(key, kind, i, v["b"])) % size_a).otherwise(v["a"])
        new_b = F.when(even, v["b"]).otherwise((v["b"] + _round_value(key, kind, i, v["a"])) % size_b)
        return F.struct(_long(new_a).alias("a"), _long(new_b).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.element_at(F.array(*(_lit(10**k) for k in range(19))), n.cast("int") + 1)


def _digits(key: Column, kind: Column, d: Column) -> Column:
    """A string of 2 to 36 digits, permuted over those of its length."""
    u = F.floor(F.length(d) / 2).cast("int")
    w = F.length(d) - u
    out = feistel(key, F.concat(kind, F.length(d).cast("string")), F.substring(d, F.lit(1), u), F.substring(d, u + 1, w), _power(u), _power(w))
    return F.transform(F.array(out), lambda v: F.concat(F.lpad(v["a"].cast("string"), u, F.lit("0")), F.lpad(v["b"].cast("string"), w, F.lit("0"))))[0]


def _place(shape: Column, digits: Column, keep: Column) -> Column:
    """shape with its digits replaced in turn by those of `digits`; the first `keep` characters stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(v: Column, c: Column) -> Column:
        free = c.between("0", "9") & (F.length(v["out"]) >= keep)
        out = F.concat(v["out"], F.when(free, F.substring(digits, v["at"], F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (v["at"] + free.cast("int")).alias("at"))

    return F.aggregate(F.filter(F.split(shape, ""), lambda c: c != ""), start, step, lambda v: v["out"])


def _luhn(payload: Column) -> Column:
    """The check digit of a string of digits."""
    back = F.filter(F.split(F.reverse(payload), ""), lambda c: c != "")
    doubled = F.transform(back, lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int")))
    return (10 - F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10) % 10


def _mod97(text: Column) -> Column:
    """Of a string of digits and capitals (A is 10, Z is 35) read as one number."""
    step = lambda s, c: F.when(c.between("0", "9"), (s * 10 + (F.ascii(c) - 48)) % 97).otherwise((s * 100 + (F.ascii(c) - 55)) % 97)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _card(key: Column, x: Column) -> Column:
    d = F.regexp_replace(x, "[^0-9]", "")
    payload = F.substring(d, F.lit(1), F.length(d) - 1)
    good = F.right(d, F.lit(1)).cast("int") == _luhn(payload)
    new = F.transform(F.array(_digits(key, F.lit("card"), payload)), lambda p: F.concat(p, _luhn(p).cast("string")))[0]
    return _place(x, F.when(good, new).otherwise(_digits(key, F.lit("account"), d)), F.lit(0))


def _iban(key: Column, x: Column) -> Column:
    plain = F.replace(x, F.lit(" "), F.lit(""))
    good = _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1
    d = F.regexp_replace(F.substring(plain, F.lit(5), F.length(plain)), "[^0-9]", "")
    body = F.when(F.length(d) >= 2, _digits(key, F.concat(F.lit("iban"), F.substring(x, 1, 2)), d)).otherwise(d)

    def whole(new: Column) -> Column:
        bban = _place(F.substring(plain, F.lit(5), F.length(plain)), new, F.lit(0))
        check = F.lpad((98 - _mod97(F.concat(bban, F.substring(plain, 1, 2), F.lit("00")))).cast("string"), 2, "0")
        return _place(x, F.concat(check, new), F.lit(0))

    return F.when(good & (F.length(d) <= 36), F.transform(F.array(body), whole)[0]).otherwise(x)


def _phone(key: Column, x: Column) -> Column:
    two = F.substring(x, 2, 2).isin(*map(str, TWO_DIGIT_CODES))
    code = 1 + F.when(F.substring(x, 2, 1).isin("1", "7"), 1).when(two, 2).otherwise(3)  # of the digits, not of how they are grouped
    d = F.regexp_replace(F.substring(x, code + 1, F.length(x)), "[^0-9]", "")
    return _place(x, _digits(key, F.concat(F.lit("phone"), F.substring(x, F.lit(1), code)), d), code)


def _ssn(key: Column, x: Column) -> Column:
    area, group, serial = (_long(F.regexp_extract(x, r"^(\d{3})-(\d{2})-(\d{4})$", i)) for i in (1, 2, 3))
    good = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = (area - 1 - (area > 666).cast("bigint")) * 99 + group - 1

    def whole(v: Column) -> Column:
        a = F.floor(v["a"] / 99) + 1
        return F.format_string("%03d-%02d-%04d", a + (a >= 666).cast("bigint"), v["a"] % 99 + 1, v["b"] + 1)

    return F.when(good, F.transform(F.array(feistel(key, F.lit("ssn"), index, serial - 1, _lit(AREAS * 99), _lit(9999))), whole)[0]).otherwise(x)


def _ipv4(key: Column, x: Column) -> Column:
    o = F.transform(F.split(x, r"\."), lambda c: c.cast("bigint"))
    pair = feistel(key, F.lit("ipv4"), o[0] * 256 + o[1], o[2] * 256 + o[3], _lit(65536), _lit(65536))
    whole = lambda v: F.format_string("%d.%d.%d.%d", F.floor(v["a"] / 256), v["a"] % 256, F.floor(v["b"] / 256), v["b"] % 256)
    return F.when(~F.exists(o, lambda c: c > 255), F.transform(F.array(pair), whole)[0]).otherwise(x)


def _date(key: Column, x: Column) -> Column:
    iso = F.substring(x, 5, 1) == "-"
    day = F.coalesce(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")), F.try_to_timestamp(x, F.lit("dd/MM/yyyy"))).cast("date")
    first = F.lit("1800-01-01").cast("date")
    n = _long(F.datediff(day, first))
    pair = feistel(key, F.lit("date"), F.floor(n / DAYS_B), n % DAYS_B, _lit(DAYS_A), _lit(DAYS_B))

    def whole(v: Column) -> Column:
        new = F.date_add(first, (v["a"] * DAYS_B + v["b"]).cast("int"))
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.date_format(new, "dd/MM/yyyy"))

    return F.when((n >= 0) & (n < DAYS_A * DAYS_B), F.transform(F.array(pair), whole)[0]).otherwise(x)


def _email(key: Column, x: Column) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.encode(F.concat_ws("|", key, F.lit("email"), F.lower(x)), "UTF-8"), 256), 1, 16), F.lit("@"), F.substring_index(x, "@", -1))


def _secret(key: Column, x: Column) -> Column:
    return F.substring(F.sha2(F.encode(F.concat_ws("|", key, F.lit("secret"), F.lower(x)), "UTF-8"), 256), F.lit(1), F.length(x))


KINDS = {"email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "date": _date, "ssn": _ssn, "card": _card, "ipv4": _ipv4}


def kind_of(x: Column) -> Column:
    """The first kind whose pattern is the whole of a find."""
    return reduce(lambda rest, k: F.when(x.rlike(rf"\A(?:{PATTERNS[k]})\z"), F.lit(k)).otherwise(rest), reversed(list(PATTERNS)), F.lit(None).cast("string"))


def pseudonym(x: Column, key: Column) -> Column:
    kind = kind_of(x)
    return reduce(lambda rest, k: F.when(kind == k, KINDS[k](key, x)).otherwise(rest), KINDS, x)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, text with pseudonyms, n_replaced and kinds (distinct, comma-joined)."""
    pattern = "|".join(f"(?:{p})" for p in PATTERNS.values())
    # Most texts hold neither digits nor @: they pass after one cheap test.
    some = F.coalesce(F.col(text).rlike("[0-9@]"), F.lit(False))
    base = docs.select(F.col(id_column), F.col(text).alias("_text"), F.when(some, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("_found"))
    many = F.coalesce(F.size("_found"), F.lit(0))
    mapped = base.withColumn("_new", F.when(many > 0, F.transform("_found", lambda x: F.struct(kind_of(x).alias("kind"), x.alias("old"), pseudonym(x, F.lit(key)).alias("new")))))
    changed = F.filter("_new", lambda m: m["old"] != m["new"])
    pieces = F.zip_with(F.split("_text", pattern, -1), "_new", lambda p, m: F.concat(F.coalesce(p, F.lit("")), F.coalesce(m["new"], F.lit(""))))
    return mapped.select(
        F.col(id_column),
        F.when(many > 0, F.array_join(pieces, "")).otherwise(F.col("_text")).alias(text),
        F.coalesce(F.size(changed), F.lit(0)).alias("n_replaced"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(changed, lambda m: m["kind"]))), ","), F.lit("")).alias("kinds"),
    )


def op4_pii(spark: SparkSession, sf_dir: str, key: str = "public test key") -> DataFrame:
    """All documents with pseudonyms. In production the key comes from the operator's secret store."""
    return pseudonymise(spark.read.parquet(f"{sf_dir}/documents.parquet"), key)
