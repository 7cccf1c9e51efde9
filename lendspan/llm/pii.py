"""Format-preserving pseudonyms for personal values, in DataFrame expressions only.

Values are found by pattern and validated: card numbers by the Luhn sum, IBANs by their
remainder mod 97, addresses by their octets, dates by the calendar. What fails stays as
it is. A valid value is permuted by a keyed Feistel network over its canonical form:
one half is shifted by a keyed hash of the other half, in turn, each character within
its own class (digit, letter of one case). Check digits are computed anew, separators
stay. The permutation depends on key, kind and canonical value alone, so equal values
stay linked in whatever document or spelling they stand, and the key's holder can undo it.

Kinds: email (local part), iban, secret (hex strings assigned to a token, key, secret or
password), date, ip, ssn, card, phone.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

ROUNDS = 8
KINDS = ("email", "iban", "secret", "date", "ip", "ssn", "card", "phone")
# Days of one block within which dates are permuted: 270 x 270, about 200 years.
DATE_HALF = 270

# Patterns of the kinds, tried in this order at each place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?i:token|key|secret|password)\s{0,3}[:=]\s{0,3}[\"']?(?:[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, kind: str, round_no: str, other: str, at: str) -> str:
    """A keyed number below 65536 for place `at`, from the other half."""
    return (
        f"CAST(conv(substr(sha2(concat_ws('|', {_literal(key)}, '{kind}', {round_no}, {other}, ({at} - 1) DIV 16), 256), "
        f"4 * (({at} - 1) % 16) + 1, 4), 16, 10) AS INT)"
    )


def _shift_character(char: str, by: str, hexadecimal: bool) -> str:
    """The character moved on within its class; one of no class stays."""
    if hexadecimal:
        low = f"substr('0123456789abcdef', (locate(lower({char}), '0123456789abcdef') - 1 + {by}) % 16 + 1, 1)"
        return low
    classes = (("0", "9", 48, 10), ("a", "z", 97, 26), ("A", "Z", 65, 26), ("à", "ö", 0xE0, 23), ("À", "Ö", 0xC0, 23))
    cases = [
        f"WHEN {char} BETWEEN '{low}' AND '{high}' THEN chr({base} + (ascii({char}) - {base} + {by}) % {size})"
        for low, high, base, size in classes
    ]
    return f"CASE {' '.join(cases)} ELSE {char} END"


def _feistel(value: str, key: str, kind: str) -> str:
    """SQL for the keyed permutation of a string, character classes kept place by place."""

    def shifted(half: str, other: str) -> str:
        moved = _shift_character(f"substr({half}, k, 1)", _hash(key, kind, "i", other, "k"), kind == "secret")
        return f"if(length({half}) = 0, {half}, array_join(transform(sequence(1, length({half})), k -> {moved}), ''))"

    start = f"named_struct('a', substr({value}, 1, length({value}) DIV 2), 'b', substr({value}, length({value}) DIV 2 + 1))"
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, i) -> if(i % 2 = 0, "
        f"named_struct('a', {shifted('s.a', 's.b')}, 'b', s.b), named_struct('a', s.a, 'b', {shifted('s.b', 's.a')})), "
        "s -> concat(s.a, s.b))"
    )


def _feistel_numbers(a: str, b: str, size: int, key: str, kind: str) -> str:
    """SQL struct (a, b) permuted over pairs of numbers below `size`."""
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', {a}, 'b', {b}), (s, i) -> if(i % 2 = 0, "
        f"named_struct('a', (s.a + {_hash(key, kind, 'i', 's.b', '1')}) % {size}, 'b', s.b), "
        f"named_struct('a', s.a, 'b', (s.b + {_hash(key, kind, 'i', 's.a', '1')}) % {size})))"
    )


def _luhn_sum(digits: str) -> str:
    """Sum of the digits with every second one from the right, the last not, doubled."""
    digit = f"CAST(substr({digits}, length({digits}) - n, 1) AS INT)"
    doubled = f"(2 * {digit} - if({digit} > 4, 9, 0))"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, n) -> t + if(n % 2 = 1, {doubled}, {digit}))"


def _mod97(text: str) -> str:
    """Remainder mod 97 of digits and letters, A as 10 to Z as 35."""
    char = f"substr({text}, n, 1)"
    step = f"if({char} BETWEEN '0' AND '9', t * 10 + CAST({char} AS INT), t * 100 + ascii({char}) - 55) % 97"
    return f"aggregate(sequence(1, length({text})), 0, (t, n) -> {step})"


def _laid_out(pattern_value: str, compact: str) -> str:
    """`compact` written with the separators that stand in `pattern_value`."""
    place = f"length(regexp_replace(substr({pattern_value}, 1, p), '[^0-9A-Z]', ''))"
    char = f"substr({pattern_value}, p, 1)"
    return (
        f"array_join(transform(sequence(1, length({pattern_value})), p -> "
        f"if({char} RLIKE '[0-9A-Z]', substr({compact}, {place}, 1), {char})), '')"
    )


def _date(value: str) -> str:
    """The date of a value by the first reading that exists, else NULL."""
    plain = f"regexp_replace({value}, '[/.]', '-')"
    return f"coalesce(try_to_date({plain}, 'yyyy-MM-dd'), try_to_date({plain}, 'dd-MM-yyyy'), try_to_date({plain}, 'MM-dd-yyyy'))"


def _date_like(value: str, day: str) -> str:
    """A date in the spelling of `value`."""
    plain = f"regexp_replace({value}, '[/.]', '-')"
    styles = [(f"try_to_date({plain}, '{style}') IS NOT NULL", style) for style in ("yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy")]
    cases = " ".join(f"WHEN {test} THEN date_format({day}, '{style}')" for test, style in styles)
    return f"replace(CASE {cases} END, '-', regexp_extract({value}, '[-/.]', 0))"


def _kinds(key: str) -> dict[str, tuple[str, str]]:
    """Per kind: SQL test of a match m, and SQL for its pseudonym."""
    whole = {kind: f"m RLIKE {_literal('^(?:' + _unanchored(kind) + ')$')}" for kind in KINDS}
    compact = "regexp_replace(m, '[^0-9A-Z]', '')"
    digits = "regexp_replace(m, '[^0-9]', '')"
    body = f"substr({digits}, 1, length({digits}) - 1)"
    local = "substring_index(m, '@', 1)"
    hexes = "regexp_extract(m, '[0-9A-Fa-f]+$', 0)"
    octet = lambda n: f"CAST(split_part(m, '.', {n}) AS INT)"
    new_body = _feistel(body, key, "card")
    account = _feistel(f"substr({compact}, 5)", key, "iban")
    day_no = f"datediff({_date('m')}, DATE'1900-01-01')"
    block = f"floor({day_no} / {DATE_HALF * DATE_HALF})"
    in_block = f"CAST(pmod({day_no}, {DATE_HALF * DATE_HALF}) AS INT)"
    moved = _feistel_numbers(f"{in_block} DIV {DATE_HALF}", f"{in_block} % {DATE_HALF}", DATE_HALF, key, "date")
    new_day = (
        f"transform(array({moved}), d -> date_add(DATE'1900-01-01', "
        f"CAST({block} * {DATE_HALF * DATE_HALF} + d.a * {DATE_HALF} + d.b AS INT)))[0]"
    )
    address = _feistel_numbers(f"{octet(1)} * 256L + {octet(2)}", f"{octet(3)} * 256L + {octet(4)}", 65536, key, "ip")
    return {
        "email": (
            whole["email"],
            f"concat({_feistel(local, key, 'email')}, '@', substring_index(m, '@', -1))",
        ),
        "iban": (
            f"{whole['iban']} AND {_mod97(f'concat(substr({compact}, 5), substr({compact}, 1, 4))')} = 1",
            "transform(array(" + account + f"), b -> {_laid_out('m', _iban_of('b', compact))})[0]",
        ),
        "secret": (
            whole["secret"],
            f"concat(substr(m, 1, length(m) - length({hexes})), if({hexes} RLIKE '[A-F]', "
            f"upper({_feistel(f'lower({hexes})', key, 'secret')}), {_feistel(hexes, key, 'secret')}))",
        ),
        "date": (
            f"{whole['date']} AND {_date('m')} IS NOT NULL",
            f"transform(array({new_day}), y -> {_date_like('m', 'y')})[0]",
        ),
        "ip": (
            f"{whole['ip']} AND greatest({octet(1)}, {octet(2)}, {octet(3)}, {octet(4)}) <= 255",
            f"transform(array({address}), d -> concat_ws('.', d.a DIV 256, d.a % 256, d.b DIV 256, d.b % 256))[0]",
        ),
        "ssn": (whole["ssn"], _laid_out("m", _feistel(digits, key, "ssn"))),
        "card": (
            f"{whole['card']} AND length({digits}) BETWEEN 13 AND 19 AND {_luhn_sum(digits)} % 10 = 0",
            "transform(array(" + new_body + f"), b -> {_laid_out('m', _with_check_digit('b'))})[0]",
        ),
        "phone": (whole["phone"], _laid_out("m", f"concat({_country()}, {_feistel(_national(), key, 'phone')})")),
    }


def _unanchored(kind: str) -> str:
    """A kind's pattern without what it asks of the surroundings; a match already met that."""
    return re.sub(r"\(\?<[=!](?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)|\(\?!(?:[^()]|\([^()]*\))*\)", "", PATTERNS[kind])


def _iban_of(account: str, compact: str) -> str:
    check = _mod97(f"concat({account}, substr({compact}, 1, 2), '00')")
    return f"concat(substr({compact}, 1, 2), lpad(CAST(98 - {check} AS STRING), 2, '0'), {account})"


def _with_check_digit(body: str) -> str:
    total = _luhn_sum(f"concat({body}, '0')")
    return f"concat({body}, CAST((10 - {total} % 10) % 10 AS STRING))"


def _country() -> str:
    return "regexp_replace(regexp_extract(m, '^\\\\+([0-9]{1,3})', 1), '[^0-9]', '')"


def _national() -> str:
    return "regexp_replace(regexp_replace(m, '^\\\\+[0-9]{1,3}', ''), '[^0-9]', '')"


def pseudonyms(docs: DataFrame, key: str, text: str = "text", kinds: tuple = KINDS) -> DataFrame:
    """All rows and columns, with `text` rewritten and n_values, the number of values replaced.

    One projection: no shuffle, so neither hot values nor hot documents gather anywhere.
    NULL texts stay NULL with n_values 0; repeated rows give repeated results. A column
    n_values of the input is replaced.
    """
    rules = _kinds(key)
    tests = " ".join(f"WHEN {rules[k][0]} THEN {rules[k][1]}" for k in KINDS if k in kinds)
    pattern = _literal(ANY)
    source = f"`{text}`"
    has_any = f"{source} RLIKE '[@0-9]'"
    # candidates with their replacement, NULL where validation fails
    found = f"transform(regexp_extract_all({source}, {pattern}, 0), m -> named_struct('m', m, 'r', CASE {tests} END))"
    found = f"if({has_any}, {found}, array())"
    # a column of the input by this name would else give way to the values found
    (held,) = free_names(docs, "_found")
    rewritten = (
        f"array_join(transform(split({source}, {pattern}, -1), (part, j) -> concat(part, if(j < size({held}), "
        f"coalesce({held}[j].r, {held}[j].m), ''))), '')"
    )
    columns = [c for c in docs.columns if c not in (text, "n_values")]
    return docs.withColumn(held, F.expr(found)).select(
        *[
            F.expr(f"if(size({held}) > 0, {rewritten}, {source})").alias(text) if c == text else _quoted(c)
            for c in docs.columns
            if c in columns or c == text
        ],
        F.expr(f"CAST(if({source} IS NULL, 0, size(filter({held}, f -> f.r IS NOT NULL))) AS BIGINT)").alias("n_values"),
    )


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
