"""Format-preserving pseudonyms for personal numbers, dates and addresses, in SQL only.

Method
    One pattern finds candidates; a candidate counts only if it is valid in its format:
    card numbers by their check digit, account numbers (IBAN) by remainder 97, dates by the
    calendar, addresses by octet range, social security numbers by their issued ranges,
    phone numbers by their country code or by the groups of a national plan. The value (digits, day number, address number) is
    permuted by a keyed Feistel network over exactly its domain, walking on while a result
    falls outside, and written back into the same format with the same separators and a
    valid check digit. A permutation keeps different values different, and equal values
    meet again in every document. Round values come from SHA-256 over key, kind, round and
    half. E-mail addresses and access keys are no numbers; they get keyed digests.

Kept as they are: country code of phone numbers, first digit of cards, country of
account numbers, separators and letter case. Numbers that fail validation are no finds.

Scale
    A projection: no shuffle, no Python. Texts without a digit or @ are passed through
    before the pattern is tried.

Edge cases
    A null text stays null, with null counts; an empty text stays empty. Equal rows have
    equal results. Other columns are kept by `pseudonymise`; columns named like its results
    are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Steps of cycle walking; a step falls outside with a chance below one in a hundred.
WALK = 12
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to the end of 2099

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Length of account numbers by country (IBAN registry); others are found if all digits.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}(?![0-9A-Za-z])" for n, c in _IBAN_LENGTHS.items()
)
#: International country codes, where no separator shows their end.
_COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"

#: National numbers with a leading 0, in the groups in which their country writes them: pairs (FR),
#: area and number (GB), area and one group (DE). A count of digits alone is no phone number.
_NATIONAL = (
    r"0[1-9](?:[ .-][0-9]{2}){4}|\(?02[0-9]\)?[ -][0-9]{4}[ -][0-9]{4}|\(?0[1-9][0-9]{2}\)?[ -][0-9]{3}[ -][0-9]{4}|"
    r"\(?0[1-9][0-9]{3}\)?[ -](?:[0-9]{6}|[0-9]{3}[ -][0-9]{3})|\(?0[2-9][0-9]{1,3}\)?[ /-][0-9]{5,8}"
)

#: Kinds in the order in which they are tried, each with its pattern.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "key": r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{40}|[0-9A-F]{40})(?![0-9A-Za-z])",
    "password": r"(?i:password|passwd|secret)=[^\s\"'()<>,;]{6,}",
    "iban": rf"(?<![0-9A-Za-z])(?:{_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9]{{4}}){{2,7}}(?: ?[0-9]{{1,3}})?(?![0-9A-Za-z]))",
    "ipv4": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![./-]?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "card": r"(?<![0-9A-Za-z.+-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z]|[.-][0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?|(?<![0-9A-Za-z.+-]))(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])",
    "international": r"\+(?:[0-9]{8,15}|[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?|[0-9]{1,4}[ .-])[0-9]{2,8}(?:[ .-][0-9]{2,8}){0,4})(?![0-9A-Za-z]|[.-][0-9])",
    "national": rf"(?<![0-9A-Za-z.+/-])(?<![0-9][ .-])(?:{_NATIONAL})(?![0-9A-Za-z]|[ ./-][0-9])",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _div(x: Column, y: Column | int) -> Column:
    """Exact integer division; a quotient of doubles is wrong above 2^53."""
    y = F.lit(y).cast("bigint") if isinstance(y, int) else y
    return (x - x % y).cast("decimal(20,0)").__truediv__(y).cast("bigint")


def _round(key: str, kind: str, number: Column, tweak: Column, half: Column) -> Column:
    """A number below 2^60 from key, kind, round, tweak and one half."""
    parts = F.concat_ws("|", F.lit(key), F.lit(kind), number, tweak, half)
    return F.conv(F.substring(F.sha2(parts, 256), 1, 15), 16, 10).cast("bigint")


def _network(key: str, kind: str, x: Column, left: Column, right: Column, tweak: Column) -> Column:
    """Permute x below left * right: rounds change the two halves in turn."""
    start = F.struct(_div(x, right).alias("l"), (x % right).alias("r"))

    def step(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]
        new_l = F.when(i % 2 == 0, (l + _round(key, kind, i, tweak, r) % left) % left).otherwise(l)
        new_r = F.when(i % 2 == 1, (r + _round(key, kind, i, tweak, l) % right) % right).otherwise(r)
        return F.struct(new_l.cast("bigint").alias("l"), new_r.cast("bigint").alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, step, lambda s: s["l"] * right + s["r"])


def permute(key: str, kind: str, x: Column, size: int, tweak: Column | None = None) -> Column:
    """Keyed permutation of 0 … size - 1."""
    left = int(size**0.5)
    while left * left < size:
        left += 1
    right = -(-size // left)
    tweak = F.lit("") if tweak is None else tweak
    step = lambda v: _network(key, kind, v, F.lit(left).cast("bigint"), F.lit(right).cast("bigint"), tweak)
    if left * right == size:
        return step(x.cast("bigint"))
    walk = F.array(*[F.lit(i) for i in range(WALK)])
    return F.aggregate(walk, step(x.cast("bigint")), lambda v, _: F.when(v >= size, step(v)).otherwise(v))


def permute_digits(key: str, kind: str, digits: Column, tweak: Column | None = None) -> Column:
    """Keyed permutation of digit texts of the same length, 1 to 18 digits."""
    n = F.length(digits)
    power = lambda e: F.rpad(F.lit("1"), (e + 1).cast("int"), F.lit("0")).cast("bigint")
    half = F.floor(n / 2).cast("int")
    tweak = F.concat_ws("|", n.cast("string"), F.lit("") if tweak is None else tweak)
    mixed = _network(key, kind, digits.cast("bigint"), power(half), power(n - half), tweak)
    return F.lpad(mixed.cast("string"), n, F.lit("0"))


def _chars(digits: Column) -> Column:
    return F.filter(F.split(digits, ""), lambda c: c != "")


def luhn_sum(digits: Column) -> Column:
    """Check sum modulo 10; the last digit counts once, the one before it doubled."""
    values = F.transform(
        F.reverse(_chars(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            (c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda s, v: s + v) % 10


def remainder_97(number: Column) -> Column:
    """Remainder of a long digit text."""
    return F.aggregate(_chars(number), F.lit(0), lambda s, c: (s * 10 + c.cast("int")) % 97)


def _iban_number(country: Column, check: Column, rest: Column) -> Column:
    plain = lambda c: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string"))
    return F.array_join(F.transform(_chars(F.concat(rest, country, check)), plain), "")


def permute_letters(key: str, kind: str, letters: Column, tweak: Column) -> Column:
    """Keyed permutation of capital letters of the same length, 0 to 12."""
    n = F.length(letters)
    power = lambda e: F.pow(F.lit(26.0), e).cast("bigint")
    half = F.floor(n / 2).cast("int")
    number = F.aggregate(_chars(letters), F.lit(0).cast("bigint"), lambda s, c: s * 26 + F.ascii(c) - 65)
    mixed = _network(key, kind, number, power(half), power(n - half), F.concat_ws("|", n.cast("string"), tweak))
    start = F.struct(mixed.alias("x"), F.lit("").alias("out"))
    step = lambda s, _: F.struct(
        _div(s["x"], 26).alias("x"), F.concat(F.char((s["x"] % 26 + 65).cast("int")), s["out"]).alias("out")
    )
    return F.when(n == 0, "").otherwise(F.aggregate(_chars(letters), start, step, lambda s: s["out"]))


def refill(shape: Column, digits: Column, places: str = "[0-9]") -> Column:
    """The digits, one by one, in the places of the digits (or `places`) of `shape`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike(places)
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(_chars(shape), start, step, lambda s: s["out"])


def _card(key: str, value: Column) -> Column:
    d = _digits(value)
    n = F.length(d)
    inner = permute_digits(key, "card", F.substring(d, F.lit(2), n - 2), F.substring(d, 1, 1))
    body = F.concat(F.substring(d, 1, 1), inner)
    check = ((10 - luhn_sum(F.concat(body, F.lit("0")))) % 10).cast("string")
    return F.when(n.between(13, 19) & (luhn_sum(d) == 0), refill(value, F.concat(body, check)))


def _iban(key: str, value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, check, rest = F.substring(plain, 1, 2), F.substring(plain, 3, 2), F.substring(plain, F.lit(5), F.length(plain))
    digits, letters = _digits(rest), F.regexp_replace(rest, "[0-9]", "")
    first, last = F.substring(digits, 1, 15), F.substring(digits, F.lit(16), F.length(digits))
    new_first = F.when(first == "", "").otherwise(permute_digits(key, "iban", first, F.concat(country, last)))
    new_last = F.when(F.length(last) > 0, permute_digits(key, "iban", last, F.concat(country, new_first))).otherwise("")
    new_digits = F.concat(new_first, new_last)
    # Digits and letters each in their own alphabet and places; twelve letters at a time.
    new_letters = F.concat(*[
        permute_letters(key, "iban-letters", F.substring(letters, at, 12), F.concat_ws("|", country, F.lit(str(at))))
        for at in (1, 13, 25)
    ])
    has_letters = rest.rlike("[A-Z]")
    new_rest = F.when(has_letters, refill(refill(rest, new_digits), new_letters, "[A-Z]")).otherwise(new_digits)
    valid = remainder_97(_iban_number(country, check, rest)) == 1
    return F.when(valid, F.transform(F.array(new_rest), lambda r: _iban_text(value, country, r))[0])


def _iban_text(value: Column, country: Column, new_rest: Column) -> Column:
    """The new account number with its check digits, in the places of `value`."""
    new_check = F.lpad((98 - remainder_97(_iban_number(country, F.lit("00"), new_rest))).cast("string"), 2, "0")
    return F.concat(country, refill(F.substring(value, F.lit(3), F.length(value)), F.concat(new_check, new_rest), "[0-9A-Z]"))


def _ipv4(key: str, value: Column) -> Column:
    octets = F.split(value, r"\.")
    number = reduce(lambda s, i: s * 256 + octets[i].cast("bigint"), range(4), F.lit(0).cast("bigint"))
    new = permute(key, "ipv4", number, 1 << 32)
    return F.concat_ws(".", *[_div(new, 1 << s) % 256 for s in (24, 16, 8, 0)])


def _date(key: str, value: Column) -> Column:
    parts = F.split(value, "[./-]")
    iso, slash = F.substring(value, 5, 1) == "-", F.substring(value, 3, 1) == "/"
    # Year first; after slashes the month comes first unless only the day can be that large.
    month_first = slash & (parts[0].cast("int") <= 12)
    year = F.when(iso, parts[0]).otherwise(parts[2])
    month = F.when(iso, parts[1]).otherwise(F.when(month_first, parts[0]).otherwise(parts[1]))
    day = F.when(iso, parts[2]).otherwise(F.when(month_first, parts[1]).otherwise(parts[0]))
    known = F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd")
    at = F.datediff(known, F.lit(FIRST_DAY).cast("date"))
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), permute(key, "date", at, DAYS).cast("int"))
    # A date is linked by its day; a written order keeps to itself.
    shape = F.when(iso, "yyyy-MM-dd").when(month_first, "MM/dd/yyyy").when(slash, "dd/MM/yyyy").otherwise("dd.MM.yyyy")
    shown = (
        F.when(shape == "yyyy-MM-dd", F.date_format(new, "yyyy-MM-dd"))
        .when(shape == "MM/dd/yyyy", F.date_format(new, "MM/dd/yyyy"))
        .when(shape == "dd/MM/yyyy", F.date_format(new, "dd/MM/yyyy"))
        .otherwise(F.date_format(new, "dd.MM.yyyy"))
    )
    return F.when(at.between(0, DAYS - 1), shown)


def _ssn(key: str, value: Column) -> Column:
    parts = F.split(value, "-")
    area, group, serial = (parts[i].cast("bigint") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    new = permute(key, "ssn", (place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
    new_place = _div(new, 99 * 9999)
    new_area = new_place + 1 + F.when(new_place >= 665, 1).otherwise(0)
    show = lambda x, n: F.lpad(x.cast("string"), n, "0")
    written = F.concat_ws("-", show(new_area, 3), show(_div(new, 9999) % 99 + 1, 2), show(new % 9999 + 1, 4))
    return F.when(valid, written)


def _phone(key: str, value: Column) -> Column:
    plain = value.rlike(r"^\+[0-9]+$")
    country = (
        F.when(plain, F.regexp_extract(value, rf"^\+({_COUNTRY})", 1))
        .when(value.startswith("+"), F.regexp_extract(value, r"^\+([0-9]{1,3}?)(?=[ .(-])", 1))
        .otherwise("")
    )
    d = _digits(value)
    rest = F.substring(d, F.length(country) + 1, F.length(d))
    return F.when(
        F.length(d).between(8, 15), refill(value, F.concat(country, permute_digits(key, "phone", rest, country)))
    )


def _digest(key: str, kind: str, value: Column, n: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256), 1, n)


def _email(key: str, value: Column) -> Column:
    same = F.lower(value)
    return F.concat(
        F.lit("u"), _digest(key, "email", same, 16), F.lit("@d"),
        _digest(key, "domain", F.substring_index(same, "@", -1), 12), F.lit(".invalid"),
    )


def _access_key(key: str, value: Column) -> Column:
    made = _digest(key, "key", F.lower(value), 40)
    return (
        F.when(value.startswith("AKIA"), F.concat(F.lit("AKIA"), F.upper(F.substring(made, 1, 16))))
        .when(value.rlike("[a-f]"), made)
        .otherwise(F.upper(made))
    )


def _password(key: str, value: Column) -> Column:
    word = F.substring(value, F.lit(1), F.instr(value, "="))
    secret = F.substring(value, F.instr(value, "=") + 1, F.length(value))
    return F.concat(word, F.substring(_digest(key, "password", secret, 64), F.lit(1), F.least(F.length(secret), F.lit(64))))


_MAKERS = {
    "email": _email, "key": _access_key, "password": _password, "iban": _iban, "ipv4": _ipv4,
    "date": _date, "ssn": _ssn, "card": _card, "phone": _phone,
    "international": _phone, "national": _phone,
}


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one candidate, null where it is not valid.

    The first kind whose shape fits decides: what fails there is no find of another kind.
    """
    shapes = [(value.rlike(f"^(?:{p})$"), _MAKERS[k](key, value)) for k, p in PATTERNS.items()]
    return reduce(lambda rest, s: F.when(s[0], s[1]).otherwise(rest), reversed(shapes), F.lit(None).cast("string"))


def pseudonymise(documents: DataFrame, key: str, text: str = "text", replaced: str = "n_replaced") -> DataFrame:
    """The documents with pseudonyms in their texts, and the count of values replaced."""
    pattern = "|".join(f"(?:{p})" for p in PATTERNS.values())
    body = F.col(text)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    candidate = body.rlike("[0-9@=]")
    none = F.array().cast("array<string>")
    found = documents.select(
        row, body.alias("_text"),
        F.when(candidate, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none).alias("_found"),
        F.when(candidate, F.split(body, pattern, -1)).otherwise(F.array(body)).alias("_between"),
    )
    new = found.select(
        "_row", "_text", "_found", "_between",
        F.transform("_found", lambda v: pseudonym(key, v)).alias("_new"),
    )
    shown = F.zip_with("_found", "_new", lambda old, now: F.coalesce(now, old))
    pieces = F.zip_with("_between", F.array_append(shown, F.lit("")), lambda gap, value: F.concat(gap, value))
    changed = F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col("_text"))
    count = F.when(F.col("_text").isNotNull(), F.size(F.filter("_new", lambda v: v.isNotNull())))
    columns = [
        changed.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in documents.columns if c != replaced
    ]
    return new.select(*columns, count.alias(replaced))
