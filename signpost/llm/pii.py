"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Numbers, dates, addresses and keys found in a text are validated and then permuted under a
secret key within their own format, so a pseudonym is again a valid value of its kind and equal
values get equal pseudonyms in every document, however they are punctuated. The permutation is
a Feistel network: in each round one half of the value is shifted by a keyed SHA-256 of the
other half, character by character within its alphabet, or modulo the half's range for dates
and IP addresses. It can be undone with the key.

What is left of each kind: a payment card keeps its length and its Luhn remainder; an IBAN its
country and valid check digits; a date is a valid date of the same 400 years in the same order
of day, month and year; a phone number keeps its country code; an e-mail address its domain; a
key or token its alphabet. Numbers that fail validation (a long number without Luhn remainder
0, a date with month 13, an octet over 255) are not personal data and stay as they are.

Defined results: a null text stays null and an empty one empty; texts without such values are
returned unchanged; every other column is kept, whatever its name; rows are never dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signpost.llm.tables import unique_name

ROUNDS = 8

# Alphabets whose characters stay within the alphabet.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ACCENTED_LOWER = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
ACCENTED_UPPER = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
HEX_LOWER, HEX_UPPER = "abcdef", "ABCDEF"

WORD_ALPHABETS = (DIGITS, LOWER, UPPER, ACCENTED_LOWER, ACCENTED_UPPER)
HEX_ALPHABETS = (DIGITS, HEX_LOWER, HEX_UPPER)

# A Gregorian cycle: 400 years have 146097 = 189 * 773 days.
CYCLE, CYCLE_LEFT, CYCLE_RIGHT = 146_097, 189, 773
CYCLE_START = "1800-01-01"

# Every repeated group is bounded, a domain's labels as in DNS: Java matches groups by recursion.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,}",
    "secret": r"(?i:token|secret|passwd|password|api[_-]?key)[\"']?\s*[=:]\s*[\"']?[A-Za-z0-9+/_-]{16,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\d]|[-/.]\d)",
    "social": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{1,4}){3,7}(?!\d)"
    r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<!\d)(?:\d{4}([ -])\d{4}\3\d{4}\3\d{1,7}|\d{4}([ -])\d{6}\4\d{5}|\d{13,19})(?!\d)",
}
ANY = "|".join(PATTERNS.values())


def _f(key: str, kind: str, turn: str, half: str) -> str:
    """SQL for the round function: 64 hex digits."""
    return f"sha2(concat('{key}|{kind}|', {turn}, '|', {half}), 256)"


def _shift(char: str, by: str, alphabets: tuple[str, ...]) -> str:
    cases = " ".join(
        f"when locate({char}, '{a}') > 0 then "
        f"substr('{a}', (locate({char}, '{a}') - 1 + {by}) % {len(a)} + 1, 1)"
        for a in alphabets
    )
    return f"case {cases} else {char} end"


def permute_text(value: str, key: str, kind: str, alphabets: tuple[str, ...]) -> str:
    """SQL for a keyed permutation of the strings that share `value`'s alphabets, place by place."""

    def added(half: str, other: str, turn: str) -> str:
        # Fifteen characters share a hash; a longer half takes one more for each further fifteen.
        by = "cast(conv(substr(h, (p % 15) * 4 + 1, 4), 16, 10) as int)"
        block = "hs[cast(p div 15 as int)]"
        one = _shift("c", by.replace("substr(h,", f"substr({block},"), alphabets)
        hashes = f"transform(sequence(0, length({half}) div 15), b -> {_f(key, kind, f'concat({turn}, b)', other)})"
        letters = f"transform(filter(split({half}, ''), x -> x <> ''), (c, p) -> {one})"
        return f"transform(array({hashes}), hs -> array_join({letters}, ''))[0]"

    start = f"named_struct('l', substr(v, 1, length(v) div 2), 'r', substr(v, length(v) div 2 + 1))"
    step = (
        f"case when t % 2 = 0 then named_struct('l', {added('s.l', 's.r', 't')}, 'r', s.r) "
        f"else named_struct('l', s.l, 'r', {added('s.r', 's.l', 't')}) end"
    )
    return (
        f"transform(array({value}), v -> aggregate(sequence(0, {ROUNDS - 1}), {start}, "
        f"(s, t) -> {step}, s -> concat(s.l, s.r)))[0]"
    )


def permute_number(value: str, key: str, kind: str, left: int, right: int) -> str:
    """SQL for a keyed permutation of the numbers 0 .. left * right - 1."""

    def moved(half: str, other: str, size: int) -> str:
        drawn = f"cast(conv(substr({_f(key, kind, 't', other)}, 1, 12), 16, 10) as bigint)"
        return f"({half} + {drawn}) % {size}"

    start = f"named_struct('l', cast(n div {right} as bigint), 'r', cast(n % {right} as bigint))"
    step = (
        f"case when t % 2 = 0 then named_struct('l', {moved('s.l', 's.r', left)}, 'r', s.r) "
        f"else named_struct('l', s.l, 'r', {moved('s.r', 's.l', right)}) end"
    )
    return (
        f"transform(array(cast({value} as bigint)), n -> aggregate(sequence(0, {ROUNDS - 1}), {start}, "
        f"(s, t) -> {step}, s -> s.l * {right} + s.r))[0]"
    )


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _refill(shape: str, chars: str, kept: str) -> str:
    """SQL that puts `chars`, one by one, where `shape` has characters of class `kept`."""
    place = f"length(regexp_replace(substr(w, 1, p + 1), '[^{kept}]', ''))"
    return (
        f"transform(array({chars}), d -> transform(array({shape}), w -> array_join(transform("
        f"filter(split(w, ''), x -> x <> ''), (c, p) -> if(c rlike '[{kept}]', substr(d, {place}, 1), c)), ''))[0])[0]"
    )


def luhn_remainder(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits, modulo 10."""
    return (
        f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + transform(array("
        f"cast(substr({digits}, length({digits}) - i + 1, 1) as int) * if(i % 2 = 0, 2, 1)), x -> if(x > 9, x - 9, x))[0], "
        f"a -> a % 10)"
    )


def _card(m: str, key: str) -> str:
    d = _digits(m)
    payload = permute_text("substr(d0, 1, length(d0) - 1)", key, "card", (DIGITS,))
    open_sum = luhn_remainder("concat(y, '0')")
    closed = f"transform(array({payload}), y -> concat(y, cast((10 - {open_sum}) % 10 as string)))[0]"
    return (
        f"transform(array({d}), d0 -> if({luhn_remainder('d0')} = 0, {_refill(m, closed, '0-9')}, {m}))[0]"
    )


def mod97(text: str) -> str:
    """SQL: an IBAN's remainder; letters count as 10 to 35."""
    value = f"if(c rlike '[0-9]', cast(c as int), ascii(c) - 55)"
    return (
        f"aggregate(filter(split({text}, ''), x -> x <> ''), 0, (a, c) -> "
        f"(a * if(c rlike '[0-9]', 10, 100) + {value}) % 97)"
    )


def _iban(m: str, key: str) -> str:
    compact = f"replace({m}, ' ', '')"
    inner = permute_text("substr(i0, 5)", key, "iban", (DIGITS, UPPER))
    turned = "concat(y, substr(i0, 1, 2), '00')"
    whole = (
        f"transform(array({inner}), y -> concat(substr(i0, 1, 2), "
        f"lpad(cast(98 - {mod97(turned)} as string), 2, '0'), y))[0]"
    )
    valid = f"{mod97('concat(substr(i0, 5), substr(i0, 1, 4))')} = 1"
    return f"transform(array({compact}), i0 -> if({valid}, {_refill(m, whole, 'A-Z0-9')}, {m}))[0]"


def _ip(m: str, key: str) -> str:
    number = (
        f"aggregate(split({m}, '[.]'), cast(0 as bigint), (a, o) -> a * 256 + cast(o as bigint))"
    )
    octets = "concat_ws('.', shiftright(q, 24), shiftright(q, 16) & 255, shiftright(q, 8) & 255, q & 255)"
    return f"transform(array({permute_number(number, key, 'ip', 65536, 65536)}), q -> {octets})[0]"


def _date(m: str, key: str) -> str:
    """Year first, or day and month (month and day, if only that is a date) and year."""
    made = "try_to_date(concat_ws('-', lpad({y}, 4, '0'), lpad({m}, 2, '0'), lpad({d}, 2, '0')), 'yyyy-MM-dd')"
    year_first = "length(g[0]) = 4"
    day = made.format(y="g[0]", m="g[1]", d="g[2]")
    dmy = made.format(y="g[2]", m="g[1]", d="g[0]")
    mdy = made.format(y="g[2]", m="g[0]", d="g[1]")
    number = f"datediff(o.day, date'{CYCLE_START}')"
    inside = permute_number(f"pmod({number}, {CYCLE})", key, "date", CYCLE_LEFT, CYCLE_RIGHT)
    moved = (
        f"date_add(date'{CYCLE_START}', cast(floor({number} / {CYCLE}) * {CYCLE} + {inside} as int))"
    )
    parts = {"y": "date_format(t, 'yyyy')", "m": "date_format(t, 'M')", "d": "date_format(t, 'd')"}

    def written(order: str) -> str:
        return ", ".join(
            parts[x] if x == "y" else f"if(length(g[{i}]) = 2, lpad({parts[x]}, 2, '0'), {parts[x]})"
            for i, x in enumerate(order)
        )

    form = (
        f"case o.form when 'ymd' then concat_ws(sep, {written('ymd')}) "
        f"when 'dmy' then concat_ws(sep, {written('dmy')}) else concat_ws(sep, {written('mdy')}) end"
    )
    read = (
        f"case when {year_first} then named_struct('form', 'ymd', 'day', {day}) "
        f"when {dmy} is not null then named_struct('form', 'dmy', 'day', {dmy}) "
        f"else named_struct('form', 'mdy', 'day', {mdy}) end"
    )
    return (
        f"transform(array(regexp_extract({m}, '([-/.])', 1)), sep -> transform(array(split({m}, '[-/.]')), g -> "
        f"transform(array({read}), o -> if(o.day is null, {m}, transform(array({moved}), t -> {form})[0]))[0])[0])[0]"
    )


def _phone(m: str, key: str) -> str:
    """The country code stays; equal national numbers are linked, whatever their punctuation."""
    code = (
        f"if({m} like '+%', if({m} rlike '^[+][0-9]{{1,3}}[^0-9]', regexp_extract({m}, '^[+][0-9]+', 0), substr({m}, 1, 3)), '')"
    )
    national = permute_text(_digits("rest"), key, "phone", (DIGITS,))
    return (
        f"transform(array({code}), k -> transform(array(substr({m}, length(k) + 1)), rest -> "
        f"concat(k, {_refill('rest', national, '0-9')}))[0])[0]"
    )


def _social(m: str, key: str) -> str:
    """Area 001 to 899 without 666, group 01 to 99, number 0001 to 9999."""
    d = _digits(m)
    area, group, serial = (f"cast(substr(d1, {a}, {n}) as int)" for a, n in ((1, 3), (4, 2), (6, 4)))
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    index = f"(({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1) * 9999 + {serial} - 1"
    shown = (
        "concat_ws('-', lpad(cast(q div 989901 + if(q div 989901 >= 665, 2, 1) as string), 3, '0'), "
        "lpad(cast((q div 9999) % 99 + 1 as string), 2, '0'), lpad(cast(q % 9999 + 1 as string), 4, '0'))"
    )
    moved = permute_number(index, key, "social", 898 * 99, 9999)
    return f"transform(array({d}), d1 -> if({valid}, transform(array({moved}), q -> {shown})[0], {m}))[0]"


def _email(m: str, key: str) -> str:
    """The name is permuted in lower case and gets its capitals back; the domain stays."""
    name = f"substring_index({m}, '@', 1)"
    moved = permute_text(f"lower({name})", key, "email", WORD_ALPHABETS)
    cased = (
        f"transform(array({moved}), d -> array_join(transform(filter(split({name}, ''), x -> x <> ''), (c, p) -> "
        f"if(c <> lower(c) and length(upper(substr(d, p + 1, 1))) = 1, upper(substr(d, p + 1, 1)), substr(d, p + 1, 1))), ''))[0]"
    )
    return f"concat({cased}, '@', substring_index({m}, '@', -1))"


def _secret(m: str, key: str) -> str:
    value = f"regexp_extract({m}, '[A-Za-z0-9+/_-]+$', 0)"
    plain = permute_text("z", key, "secret", WORD_ALPHABETS)
    hexed = permute_text("z", key, "secret", HEX_ALPHABETS)
    return (
        f"transform(array({value}), z -> concat(substr({m}, 1, length({m}) - length(z)), "
        f"if(z rlike '^[0-9a-fA-F]+$', {hexed}, {plain})))[0]"
    )


def pseudonym(value: str, key: str) -> str:
    """SQL for the pseudonym of one match of `ANY`; the value itself if it is not valid."""
    makers = {
        "email": _email, "secret": _secret, "iban": _iban, "ip": _ip,
        "date": _date, "social": _social, "phone": _phone, "card": _card,
    }
    tests = {
        "email": f"{value} like '%@%'",
        "secret": f"{value} rlike '^[a-zA-Z_-]+[\"\\']?\\\\s*[=:]'",
        "iban": f"{value} rlike '^[A-Z]{{2}}[0-9]{{2}}'",
        "ip": f"{value} rlike '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$'",
        "date": f"{value} rlike '^([0-9]{{4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}|[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{4}})$'",
        "social": f"{value} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$'",
        "phone": f"{value} rlike '^([+(]|[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}$)'",
    }
    cases = " ".join(f"when {tests[k]} then {makers[k](value, key)}" for k in tests)
    return f"case {cases} else {makers['card'](value, key)} end"


def pseudonymize(docs: DataFrame, key: str, column: str = "text", count_as: str | None = None) -> DataFrame:
    """`docs` with pseudonyms in `column`; `count_as` adds the number of values replaced.

    `key` must be a secret of letters and digits. Only texts with a digit, an at sign or an
    assignment are searched.
    """
    if not key.isalnum():
        raise ValueError("key must consist of letters and digits")
    found, gaps, new = (unique_name(docs, n) for n in ("pii_found", "pii_gaps", "pii_new"))
    text = F.col(column)
    may = text.rlike("[0-9@=:]")
    hits = docs.withColumn(found, F.when(may, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))).withColumn(
        gaps, F.when(F.size(found) > 0, F.split(text, ANY, -1))
    )
    made = hits.withColumn(new, F.expr(f"transform(`{found}`, m -> {pseudonym('m', key)})"))
    joined = F.expr(f"concat(`{gaps}`[0], array_join(transform(`{new}`, (x, i) -> concat(x, `{gaps}`[i + 1])), ''))")
    kept = [F.when(F.size(found) > 0, joined).otherwise(text).alias(c) if c == column else F.col(f"`{c}`") for c in docs.columns]
    if count_as:
        kept.append(F.expr(f"cast(coalesce(size(filter(zip_with(`{found}`, `{new}`, (a, b) -> a <> b), x -> x)), 0) as bigint)").alias(count_as))
    return made.select(*kept)
