"""Format-preserving pseudonyms: valid numbers and dates are permuted within their format by a keyed Feistel network.

Equal values get equal pseudonyms everywhere, so they stay linked, and different values never meet in one. A digit stays a digit, a
letter a letter of its case, separators stay, and the result is again valid: payment numbers keep their check digit, dates are
dates, addresses have octets up to 255. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
#: Days of 400 Gregorian years, as the product of the two sides of the dates' network.
_DAYS, _LEFT, _RIGHT = 146_097, 189, 773
#: Social numbers: 898 areas of 99 groups, and serial numbers.
_SOCIAL = (898 * 99, 9_999)

# Countries by the length of their IBAN.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS",
    23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT", 32: "LC",
}

# What is looked for. A match is replaced only if it is valid.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)",
    "address": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join(rf'(?:{c.replace(" ", "|")})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}' for n, c in IBAN.items())})(?![A-Za-z0-9])",
    "phone": r"(?<!\d)(?:\+?\d{1,3}[ .-])?(?:\(\d{3}\)[ .-]?\d{3}[ .-]|\d{3}-\d{3}-|(?<!\d[ .])(?:\d{3}\.\d{3}\.|\d{3} \d{3} ))\d{4}(?!\d|[.-]\d)",
    "international": r"(?<!\d)\+(?=[1-9](?:[ .()-]{0,2}\d){7})\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,5}(?!\d)",
    "payment": r"(?<!\d)(?<!\d-)(?:\d{4}([ .-])(?:\d{4}\{SEP}\d{4}\{SEP}\d{1,7}|\d{6}\{SEP}\d{4,5}|\d{3}\{SEP}\d{3}\{SEP}\d{3})|\d{13,19})(?!\d|-\d)",
    "social": r"(?<!\d)(?<!\d-)\d{3}-\d{2}-\d{4}(?!\d|-\d)",
}


def _pattern() -> str:
    """All kinds in one; the payment number's separator group is numbered by its place."""
    return "|".join(p.replace("{SEP}", "1") for p in PATTERNS.values())


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _noise(key: str, turn: int, other: str, place: str = "0") -> str:
    """A 32-bit number from key, round, the other side and a place."""
    return f"cast(conv(substring(sha2(concat_ws('|', '{key}', {turn}, {other}, cast({place} as string)), 256), 1, 8), 16, 10) as bigint)"


def _numbers(key: str, number: str, left: int, right: int) -> str:
    """A number below left * right, permuted: two residues in turn moved by a function of the other."""
    a, b = f"({number}) div {right}", f"({number}) % {right}"
    body = f"x.a * {right} + x.b"
    steps = [f"named_struct('a', {a}, 'b', {b})"]
    for turn in range(ROUNDS):
        steps.append(
            f"named_struct('a', (x.a + {_noise(key, turn, 'cast(x.b as string)')}) % {left}, 'b', x.b)" if turn % 2 else f"named_struct('a', x.a, 'b', (x.b + {_noise(key, turn, 'cast(x.a as string)')}) % {right})"
        )
    out = body
    for step in reversed(steps[1:]):
        out = _let("x", step, out)
    return _let("x", steps[0], out)


def _moved(text: str, by: str) -> str:
    """Each digit and letter of `text` moved within its class by `by` (of place i)."""
    step = f"""CASE WHEN c BETWEEN '0' AND '9' THEN char(48 + (ascii(c) - 48 + {by}) % 10)
        WHEN c BETWEEN 'a' AND 'z' THEN char(97 + (ascii(c) - 97 + {by}) % 26)
        WHEN c BETWEEN 'A' AND 'Z' THEN char(65 + (ascii(c) - 65 + {by}) % 26) ELSE c END"""
    return f"IF({text} = '', '', array_join(transform(split({text}, ''), (c, i) -> {step}), ''))"


def _characters(key: str, text: str) -> str:
    """ASCII text, permuted: its two halves in turn moved, character by character, by a function of the other half."""
    out = "concat(h.a, h.b)"
    for turn in reversed(range(ROUNDS)):
        mine, other = ("b", "a") if turn % 2 == 0 else ("a", "b")
        moved = _moved(f"h.{mine}", _noise(key, turn, f"h.{other}", "i"))
        fields = {mine: moved, other: f"h.{other}"}
        out = _let("h", f"named_struct('a', {fields['a']}, 'b', {fields['b']})", out)
    half = f"cast(length({text}) div 2 as int)"
    return _let("h", f"named_struct('a', substring({text}, 1, {half}), 'b', substring({text}, {half} + 1))", out)


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _check_digit(body: str) -> str:
    """The digit that makes a payment number valid (Luhn) after `body`."""
    total = f"aggregate(transform(split(reverse({body}), ''), (c, i) -> IF(i % 2 = 0, cast(c as int) * 2 div 10 + cast(c as int) * 2 % 10, cast(c as int))), 0L, (s, v) -> s + v)"
    return f"cast((10 - ({total}) % 10) % 10 as string)"


def _laid(text: str, digits: str) -> str:
    """`digits` in the places of the digits of `text`."""
    step = "IF(c BETWEEN '0' AND '9', named_struct('out', concat(a.out, substring(q, a.at, 1)), 'at', a.at + 1), named_struct('out', concat(a.out, c), 'at', a.at))"
    return _let("q", digits, f"aggregate(split({text}, ''), named_struct('out', '', 'at', 1), (a, c) -> {step}, a -> a.out)")


def _remainder(text: str) -> str:
    """`text` modulo 97, a letter counting as two digits from 10 for A."""
    return f"aggregate(split({text}, ''), 0L, (r, c) -> IF(c BETWEEN '0' AND '9', (r * 10 + ascii(c) - 48) % 97, (r * 100 + ascii(c) - 55) % 97))"


def _iban(key: str) -> str:
    """An IBAN with its account moved and its check digits made anew; m itself if its own are wrong."""
    laid = "aggregate(split(m, ''), named_struct('out', '', 'at', 1), (a, c) -> IF(c = ' ', named_struct('out', concat(a.out, c), 'at', a.at), named_struct('out', concat(a.out, substring(q, a.at, 1)), 'at', a.at + 1)), a -> a.out)"
    check = "lpad(cast(98 - " + _remainder("concat(n, substring(b, 1, 2), '00')") + " as string), 2, '0')"
    new = _let("n", _characters(key, "substring(b, 5)"), _let("q", f"concat(substring(b, 1, 2), {check}, n)", laid))
    return _let("b", "replace(m, ' ', '')", f"IF({_remainder('concat(substring(b, 5), substring(b, 1, 4))')} = 1, {new}, m)")


def _date(key: str, m: str, day: str, style: str) -> str:
    """A date moved within its 400 years."""
    number = f"datediff({day}, DATE'1600-01-01')"
    era, inside = f"floor({number} / {_DAYS}D)", f"pmod({number}, {_DAYS})"
    moved = f"date_add(DATE'1600-01-01', cast({era} * {_DAYS} + {_numbers(key, f'cast({inside} as bigint)', _LEFT, _RIGHT)} as int))"
    return f"date_format({moved}, '{style}')"


def _pseudonym(key: str) -> str:
    """SQL for the pseudonym of match m, or m itself if it is not valid."""
    cases = [f"WHEN instr(m, '@') > 0 THEN concat({_characters(key, "substring_index(m, '@', 1)")}, '@', substring_index(m, '@', -1))"]
    for shape, style in (("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"), ("^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd"), ("^[0-9]{2}[.][0-9]{2}[.][0-9]{4}$", "dd.MM.yyyy"), ("^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy")):
        y, mo, d = (style.index(x) + 1 for x in ("yyyy", "MM", "dd"))
        day = f"try_to_date(concat(substring(m, {y}, 4), '-', substring(m, {mo}, 2), '-', substring(m, {d}, 2)), 'yyyy-MM-dd')"
        if style == "dd/MM/yyyy":  # month first where the day cannot be first
            swapped = "try_to_date(concat(substring(m, 7, 4), '-', substring(m, 1, 2), '-', substring(m, 4, 2)), 'yyyy-MM-dd')"
            cases.append(f"WHEN m RLIKE '{shape}' AND {day} IS NULL THEN coalesce({_date(key, 'm', swapped, 'MM/dd/yyyy')}, m)")
        cases.append(f"WHEN m RLIKE '{shape}' THEN coalesce({_date(key, 'm', day, style)}, m)")
    octets = "transform(split(m, '[.]'), o -> cast(o as bigint))"
    number = "(element_at(o, 1) * 16777216 + element_at(o, 2) * 65536 + element_at(o, 3) * 256 + element_at(o, 4))"
    parts = "concat_ws('.', v div 16777216, v div 65536 % 256, v div 256 % 256, v % 256)"
    moved = _let("o", octets, _let("v", _numbers(key, number, 65_536, 65_536), parts))
    cases.append(f"WHEN m RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' THEN IF(forall({octets}, o -> o <= 255), {moved}, m)")
    cases.append(f"WHEN m RLIKE '^[A-Z]' THEN {_iban(key)}")
    # The zone digit of an international number stays; of others the last ten digits move, so a number is the same with and without +1.
    plus = f"concat(substring(m, 1, 2), {_let('t', 'substring(m, 3)', _laid('t', _let('d', _digits('t'), _characters(key, 'd'))))})"
    cases.append(f"WHEN startswith(m, '+') THEN {plus}")
    shape = "[(]?[0-9]{3}[) .-]{1,2}[0-9]{3}[ .-][0-9]{4}$"
    tail = f"regexp_extract(m, '{shape}', 0)"
    phone = _let("t", tail, f"concat(substring(m, 1, length(m) - length(t)), {_laid('t', _let('d', _digits('t'), _characters(key, 'd')))})")
    cases.append(f"WHEN m RLIKE '^([0-9]{{1,3}}[ .-])?{shape}' THEN {phone}")
    # Valid social numbers are counted through, so that the number they become is valid again.
    area, rest = "cast(substring(m, 1, 3) as bigint)", "cast(substring(m, 5, 2) as bigint) - 1) * 9999 + cast(substring(m, 8) as bigint) - 1"
    number = f"(({area} - IF({area} > 666, 2, 1)) * 99 + {rest}"
    parts = "concat(lpad(cast(v div 989901 + IF(v div 989901 < 665, 1, 2) as string), 3, '0'), '-', lpad(cast(v div 9999 % 99 + 1 as string), 2, '0'), '-', lpad(cast(v % 9999 + 1 as string), 4, '0'))"
    odd = "substring(m, 1, 3) IN ('000', '666') OR substring(m, 1, 1) = '9' OR substring(m, 5, 2) = '00' OR substring(m, 8) = '0000'"
    social = f"IF({odd}, m, {_let('v', _numbers(key, number, *_SOCIAL), parts)})"
    cases.append(f"WHEN m RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN {social}")
    body = _characters(key, "substring(d, 1, length(d) - 1)")
    new = _let("e", body, f"concat(e, {_check_digit('e')})")
    valid = f"length(d) >= 13 AND {_check_digit('substring(d, 1, length(d) - 1)')} = substring(d, length(d))"
    cases.append(f"ELSE {_let('d', _digits('m'), f'IF({valid}, {_laid("m", new)}, m)')}")
    return f"CASE {' '.join(cases)} END"


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """Columns of `docs` with `text` in which valid e-mail names, dates, network addresses, IBANs, phone, payment and social
    security numbers are replaced, and `n_replaced`.

    Matches that are not valid (a check digit, a day or an octet is wrong) stay. A null text stays null with 0 replaced, an empty one empty.
    Repeated rows are treated alike. A column n_replaced of `docs` is replaced. The key is a secret of the caller, of letters and digits.
    """
    if not key.isalnum():
        raise ValueError("the key has letters and digits only")
    rows = docs.drop("n_replaced").withColumn("text", F.col("text").cast("string"))
    pattern = F.lit(_pattern())
    may = F.col("text").rlike(r"@|\d[\d./ ()-]{4,}\d")
    rows = rows.withColumn("_found", F.when(may, F.regexp_extract_all("text", pattern, F.lit(0))))
    some = F.coalesce(F.size("_found") > 0, F.lit(False))
    rows = rows.withColumn("_new", F.expr(f"IF(size(_found) > 0, transform(_found, m -> {_pseudonym(key)}), NULL)"))
    between = F.split("text", _pattern(), -1)
    joined = F.array_join(F.zip_with(between, "_new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x))
    names = [F.when(some, joined).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "n_replaced"]
    return rows.select(*names, F.when(some, changed).otherwise(0).cast("int").alias("n_replaced"))
