"""Format-preserving Feistel pseudonyms for personal data, in SQL functions alone.

Personal values are found by pattern and validated (check digits, octets, the
calendar). The symbols of a value that carry it are cut in two halves, which
take turns: a half is shifted, symbol by symbol within its alphabet, by a
keyed hash of the other half. Every round can be undone with the key, so
values of one format are permuted: equal values get equal pseudonyms in all
documents and different values different ones. Nothing is looked up or
shuffled; a document's pseudonyms depend on its text and the key alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 6
#: 400 Gregorian years have 146,097 = 189 x 773 days, so a date in them is a pair of numbers.
FIRST_DAY, DAYS = "DATE '1800-01-01'", (189, 773)

_SECRET = r"(?i:password|passwd|pwd|secret|token|api_key|apikey)"
#: Lengths of IBANs without spaces, and the countries that have them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC",
    32: "LC", 33: "RU",
}
_FREE, _END = "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"
#: IBANs of their country's length, and any long run.
IBANS = (
    _FREE + "((?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + f"){_END})",
    _FREE + f"([A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END})",
)
#: Payment cards in their groups, each also where another may overlap it, and any long run.
CARDS = tuple(
    f"(?<![0-9A-Za-z-])(?=({shape}{_END}))" for shape in (
        "[0-9]{13,19}", "[0-9]{4}([ -])[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}\\2[0-9]{1,3}", "[0-9]{4}([ -])[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}",
        "[0-9]{4}([ -])[0-9]{6}\\2[0-9]{4,5}", "[0-9]{4}([ -])[0-9]{4}\\2[0-9]{4}\\2[0-9]{1,3}",
    )
) + (f"(?<![0-9A-Za-z-])([0-9](?:[ -]?[0-9]){{12,18}}{_END})",)
#: What may be personal, besides cards and IBANs; a hit counts only if it is validated below.
PATTERNS = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",  # e-mail
    r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",  # access key
    r"(?<![A-Za-z0-9])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",  # hexadecimal key
    r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",  # signed token
    rf"(?<={_SECRET}[\"']? ?[=:] ?[\"']?)[A-Za-z0-9+/_-]{{8,}}+",  # what a secret is set to
    r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",  # IPv4 address
    r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z]|-[0-9])",  # dates
    r"(?<![0-9A-Za-z.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9A-Za-z]|\.[0-9])",
    r"(?<![0-9A-Za-z/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9A-Za-z/])",
    r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",  # social security number
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])",  # telephone
    r"(?<![0-9)])\+(?![0-9]+\.[0-9]+(?![0-9.()-]| [0-9(]))[1-9](?:[ .-]?\(?[0-9]\)?){7,14}(?![0-9])",
    r"(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .-][2-9][0-9]{2}[.-][0-9]{4}(?![0-9])",
)
PATTERN = "|".join(PATTERNS)
#: A social security number that can have been given out.
SSN = "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
#: No pattern matches a text without one of these.
HINT = rf"[0-9@]|A[KS]IA|eyJ|{_SECRET}[\"']? ?[=:]"
#: Characters of a value that are permuted together; longer values are taken in stretches of so many.
TOGETHER, STRETCH = 128, 64
#: Steps of a walk along a permutation's cycle to the next valid value; one in ten is not valid.
WALK = 40


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def feistel(left: str, left_bases: str, right: str, right_bases: str, tweak: str, key: str) -> str:
    """A struct (l, lb, r, rb) of bigint arrays: both halves permuted."""
    seed = f"concat('{key}|', {tweak}, '|', i, '|', array_join(s.r, ','), '|', j div 32)"
    shift = f"CAST(conv(substring(sha2({seed}, 512), CAST(4 * (j % 32) + 1 AS INT), 4), 16, 10) AS BIGINT)"
    turned = f"transform(s.l, (x, j) -> pmod(x + {shift}, s.lb[j]))"
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('l', {left}, 'lb', {left_bases}, 'r', {right}, 'rb', {right_bases}), "
        f"(s, i) -> named_struct('l', s.r, 'lb', s.rb, 'r', {turned}, 'rb', s.lb))"
    )


def by_mask(value: str, mask: str, kind: str, key: str) -> str:
    """Permute the characters that ``mask`` marks; others stay.

    d digit, n digit that stays below or from 2, h hexadecimal, l lower, u upper, e and E letters to f.
    """
    mark, char = "substring(k, p, 1)", f"substring({value}, p, 1)"
    base = f"CAST(CASE {mark} WHEN 'd' THEN 10 WHEN 'n' THEN IF({char} < '2', 2, 8) WHEN 'h' THEN 16 WHEN 'e' THEN 6 WHEN 'E' THEN 6 ELSE 26 END AS BIGINT)"
    code = (
        f"CAST(CASE WHEN {mark} IN ('l', 'e') THEN ascii({char}) - 97 WHEN {mark} IN ('u', 'E') THEN ascii({char}) - 65 "
        f"WHEN {mark} = 'n' THEN ascii({char}) - IF({char} < '2', 48, 50) ELSE instr('0123456789abcdef', {char}) - 1 END AS BIGINT)"
    )
    halves = [f"slice(ps, 1, size(ps) div 2)", f"slice(ps, size(ps) div 2 + 1, size(ps))"]
    halves = [h.replace("size(ps) div 2", "CAST(size(ps) div 2 AS INT)") for h in halves]
    arrays = [f"transform({h}, p -> {x})" for h in halves for x in (code, base)]
    new = "o[array_position(ps, p) - 1]"
    shown = (
        f"CASE WHEN {mark} = '.' THEN {char} WHEN {mark} IN ('l', 'e') THEN char(97 + {new}) WHEN {mark} IN ('u', 'E') THEN char(65 + {new}) "
        f"WHEN {mark} = 'n' THEN char(IF({char} < '2', 48, 50) + {new}) ELSE substring('0123456789abcdef', CAST({new} AS INT) + 1, 1) END"
    )
    joined = f"array_join(transform(sequence(1, length({value})), p -> {shown}), '')"
    moved = let("f", feistel(*arrays, f"concat('{kind}', length({value}))", key), let("o", "concat(f.l, f.r)", joined))
    return let("k", mask, let("ps", f"filter(sequence(1, length({value})), p -> {mark} <> '.')", f"IF(size(ps) = 0, {value}, {moved})"))


def in_stretches(value: str, mask: Callable[[str], str], kind: str, key: str) -> str:
    """``by_mask`` of a value of any length: beyond ``TOGETHER`` characters stretch by stretch, so that the work goes with the length."""
    each = f"transform(regexp_extract_all({value}, '.{{1,{STRETCH}}}', 0), z -> {by_mask('z', mask('z'), kind, key)})"
    return f"IF(length({value}) > {TOGETHER}, array_join({each}, ''), {by_mask(value, mask(value), kind, key)})"


def plain_mask(value: str) -> str:
    """Every digit and ASCII letter within its own kind."""
    kinds = "".join(f"regexp_replace(" for _ in range(4))
    return (
        f"{kinds}{value}, '[^0-9A-Za-z]', '.'), '[a-z]', 'l'), '[A-Z]', 'u'), '[0-9]', 'd')"
    )


def luhn_digit(prefix: str) -> str:
    return f"element_at(filter(sequence(0, 9), c -> luhn_check(concat({prefix}, c))), 1)"


def mod97(text: str) -> str:
    """Remainder of letters and digits read as a number, A as 10 to Z as 35."""
    at = "instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1"
    chars = f"transform(sequence(1, length({text})), q -> substring({text}, q, 1))"
    return f"aggregate({chars}, 0, (r, c) -> CAST((r * IF(c >= 'A', 100, 10) + {at}) % 97 AS INT))"


def date_pseudonym(value: str, form: str, key: str) -> str:
    a, b = DAYS
    day = f"datediff(CAST(try_to_timestamp({value}, '{form}') AS DATE), {FIRST_DAY})"
    moved = feistel(
        f"array(CAST(n div {b} AS BIGINT))", f"array({a}L)", f"array(CAST(n % {b} AS BIGINT))", f"array({b}L)", "'date'", key,
    )
    shown = let("f", moved, f"date_format(date_add({FIRST_DAY}, CAST(f.l[0] * {b} + f.r[0] AS INT)), '{form}')")
    return let("n", day, f"IF(n >= 0 AND n < {a * b}, {shown}, {value})")


def pseudonym(value: str, key: str) -> str:
    """The value's pseudonym; the value itself if it is not validated."""
    octets = f"transform(split({value}, '[.]'), x -> CAST(x AS BIGINT))"
    ip = let("v", octets, let(
        "f", feistel("slice(v, 1, 2)", "array(256L, 256L)", "slice(v, 3, 2)", "array(256L, 256L)", "'ip'", key),
        "array_join(concat(f.l, f.r), '.')",
    ))
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    # A card keeps its first digit; its last one is computed anew.
    card_mask = f"concat('.', substring({plain_mask(value)}, 2, length({value}) - 2), '.')"
    card = let("w", by_mask(value, card_mask, "card", key), let(
        "u", "substring(w, 1, length(w) - 1)", f"concat(u, {luhn_digit('regexp_replace(u, ' + chr(39) + '[^0-9]' + chr(39) + ', ' + chr(39) * 2 + ')')})",
    ))
    phone_mask = f"regexp_replace({plain_mask(value)}, '^(.*)d(dd[^d]*)d(dd[^d]*dddd)$', '$1n$2n$3')"
    # The country code stays: up to a separator or, without one, 1, 7 or two digits.
    country = f"length(regexp_extract({value}, '^[+](?:[0-9]{{1,3}}(?=[^0-9])|[17]|[0-9]{{2}})', 0))"
    phone = by_mask(value, f"concat(repeat('.', {country}), substring({phone_mask}, {country} + 1))", "phone", key)
    bare = f"regexp_replace({value}, ' ', '')"
    rotated = f"concat(substring({bare}, 5), substring({bare}, 1, 4))"
    iban = let("w", by_mask(value, f"concat('....', substring({plain_mask(value)}, 5))", "iban", key), let(
        "z", "regexp_replace(w, ' ', '')",
        f"concat(substring(w, 1, 2), lpad(CAST(98 - {mod97('concat(substring(z, 5), substring(z, 1, 2), ' + chr(39) + '00' + chr(39) + ')')} AS STRING), 2, '0'), substring(w, 5))",
    ))
    email = by_mask(value, f"concat(substring_index({plain_mask(value)}, '.', 0), regexp_replace(substring({plain_mask(value)}, 1, instr({value}, '@') - 1), '$', '.'), "
                           f"repeat('.', length({value}) - instr({value}, '@')))", "email", key)
    hex_mask = lambda v: f"repeat('h', length({v}))"
    hexadecimal = in_stretches(value, hex_mask, "hex", key)
    upper_hexadecimal = f"upper({let('y', f'lower({value})', in_stretches('y', hex_mask, 'hex', key))})"
    mixed_mask = lambda v: f"regexp_replace(regexp_replace(regexp_replace({v}, '[a-f]', 'e'), '[A-F]', 'E'), '[0-9]', 'd')"
    access = by_mask(value, f"concat('....', substring({plain_mask(value)}, 5))", "access", key)
    secret = in_stretches(value, plain_mask, "secret", key)
    # The pseudonym of a number that is not valid is permuted again, until one is: still a permutation of the valid ones.
    ssn = f"aggregate(sequence(1, {WALK}), {value}, (t, step) -> IF(step > 1 AND t RLIKE '{SSN}', t, {by_mask('t', plain_mask('t'), 'ssn', key)}))"
    return f"""CASE
        WHEN instr({value}, '@') > 0 THEN {email}
        WHEN {value} RLIKE '^A[KS]IA[A-Z0-9]{{16}}$' THEN {access}
        WHEN {value} RLIKE '^[A-Z]{{2}}[0-9]{{2}}[ A-Z0-9]+$' AND {mod97(rotated)} = 1 THEN {iban}
        WHEN {value} RLIKE '^[0-9a-f]{{32,}}$' THEN {hexadecimal}
        WHEN {value} RLIKE '^[0-9A-F]{{32,}}$' THEN {upper_hexadecimal}
        WHEN {value} RLIKE '^[0-9a-fA-F]{{32,}}$' THEN {in_stretches(value, mixed_mask, 'hex', key)}
        WHEN {value} RLIKE '^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])[.]){{3}}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$' THEN {ip}
        WHEN {value} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND try_to_timestamp({value}, 'yyyy-MM-dd') IS NOT NULL THEN {date_pseudonym(value, 'yyyy-MM-dd', key)}
        WHEN {value} RLIKE '^[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}$' AND try_to_timestamp({value}, 'dd.MM.yyyy') IS NOT NULL THEN {date_pseudonym(value, 'dd.MM.yyyy', key)}
        WHEN {value} RLIKE '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$' AND try_to_timestamp({value}, 'MM/dd/yyyy') IS NOT NULL THEN {date_pseudonym(value, 'MM/dd/yyyy', key)}
        WHEN {value} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN
            IF({value} RLIKE '{SSN}', {ssn}, {value})
        WHEN {value} RLIKE '^[0-9][0-9 -]+$' AND length({digits}) >= 13 AND luhn_check({digits}) THEN {card}
        WHEN {value} RLIKE '^[0-9]{{8,}}$' THEN {secret}
        WHEN {value} LIKE 'eyJ%' AND instr({value}, '.') > 0 THEN {secret}
        WHEN {value} LIKE '+%' AND length({digits}) BETWEEN 8 AND 15 THEN {phone}
        WHEN {value} RLIKE '^[(]?[0-9]{{3}}[)]?[ .-][0-9]{{3}}[.-][0-9]{{4}}$' THEN {phone}
        WHEN {value} RLIKE '^[A-Za-z0-9+/_-]{{8,}}$' AND {value} RLIKE '[A-Za-z]' THEN {secret}
        ELSE {value} END"""


def _valid_iban(value: Column) -> Column:
    bare = F.regexp_replace(value, " ", "")
    code = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    chars = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")
    step = lambda r, c: ((r * F.when(c >= "A", 100).otherwise(10) + F.instr(code, c) - 1) % 97).cast("int")
    return F.aggregate(chars, F.lit(0), step) == 1


def with_pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """The rows with ``text`` replaced and ``pii_replaced``, the number of values replaced."""
    if "'" in key or "\\" in key:
        raise ValueError("the key must not hold quotes or backslashes")
    hinted = F.col("text").rlike(HINT)
    none = F.expr("CAST(array() AS array<string>)")
    # Valid cards and IBANs are looked up first, longest first, since a pattern cannot tell which of several runs is valid.
    cards, ibans = (F.concat(*(F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in shapes)) for shapes in (CARDS, IBANS))
    found = docs.withColumn("pii_valid", F.when(F.col("text").rlike("[0-9]{2}(?: ?[0-9A-Z]){11}|[0-9](?:[ -]?[0-9]){12}"), F.array_distinct(F.concat(
        F.filter(cards, lambda x: F.call_function("luhn_check", F.regexp_replace(x, "[^0-9]", ""))), F.filter(ibans, _valid_iban),
    ))).otherwise(none))
    longest = "array_sort(pii_valid, (a, b) -> length(b) - length(a))"
    free = f"transform({longest}, x -> concat(IF(x RLIKE '^[0-9]', '(?<![0-9A-Za-z-])', '{_FREE}'), x))"
    listed = F.expr(f"concat('(?:', array_join({free}, '|'), '){_END}|')")
    pattern = F.when(F.size("pii_valid") > 0, F.concat(listed, F.lit(PATTERN))).otherwise(F.lit(PATTERN))
    found = found.withColumn("pii_pattern", pattern)
    found = found.withColumn("pii_hits", F.when(hinted, F.regexp_extract_all("text", F.col("pii_pattern"), F.lit(0))).otherwise(none))
    found = found.withColumn("pii_new", F.expr(f"transform(pii_hits, h -> {pseudonym('h', key)})"))
    gaps = F.split("text", F.col("pii_pattern"), -1)
    joined = F.array_join(F.zip_with(gaps, F.col("pii_new"), lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    replaced = F.size(F.filter(F.zip_with("pii_hits", "pii_new", lambda a, b: a != b), lambda x: x))
    return (
        found.withColumn("text", F.when(F.size("pii_hits") > 0, joined).otherwise(F.col("text")))
        .withColumn("pii_replaced", replaced.cast("long")).drop("pii_valid", "pii_pattern", "pii_hits", "pii_new")
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """Per row: doc_id, text with pseudonyms, n_replaced.

    Covered: e-mail addresses (their local part), telephone (with a country
    code, or in North American form), payment card (validated by check digit
    and valid afterwards, also between other numbers), IBAN (likewise), social
    security numbers, IPv4 addresses, dates of 1800 to 2199 in three formats,
    access keys, hexadecimal keys, signed tokens, and what a password, secret
    or token is set to, in any case and of any length. Pseudonyms of validated
    kinds are valid. Other text is untouched, as are look-alikes that fail validation. A
    null text stays null, an empty one empty. Repeated rows are treated alike.
    Only doc_id and text are read. The key is part of the query's plan: keep
    plans and event logs as safe as the key.
    """
    return with_pseudonyms(docs.select("doc_id", "text"), key).select("doc_id", "text", F.col("pii_replaced").alias("n_replaced"))
