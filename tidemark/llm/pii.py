"""Format-preserving Feistel pseudonyms for personal data, in SQL functions only.

Numbers, dates and names that pass their validation are permuted within their format by a keyed Feistel network: a card stays a
card with a right check digit, a date a date written alike, an address of four octets one of four octets. The permutation
depends on the kind and the key alone, so equal values get equal pseudonyms in every document, and different values
different ones. Separators and brackets stay where they are.

Kinds: email (letters and digits before the domain, each within its kind; case counts for nothing but how it is written; letters
outside ASCII within their sixteen neighbours), iban (mod 97; all capitals or all small), date (year first or last, 1800 to
2199, with or without leading zeros; two-digit years from 1969 on, between slashes), ip (octets to 255, not after a letter), ip6
(hex digits each in its place; with a digit), ssn (valid areas; dashes or spaces), card (13 to 19 digits, Luhn; single spaces or
dashes, or groups of four between dots or double spaces), phone (10 to 15 digits; without any sign among them 10 or 11, or 00 in
front; the country code stays). What fails its validation stays as it is. Within a longer run of groups
(a card before its expiry date, an IBAN before a word in capitals) the longest valid card or IBAN from each group on counts.
Dates without leading zeros keep the numbers of digits of day and month; from the 29th on only their year changes, and
29 February so written stays.

Nulls and ties: a null text stays null and counts no finding; an empty one stays empty; repeated rows get equal results.
Very long texts are cut at their findings only. Other columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

ROUNDS = 10
KINDS = ("email", "iban", "date", "ip6", "ip", "ssn", "card", "phone")
_HEX = "[0-9A-Fa-f]{1,4}"
#: Fixed patterns, tried in this order.
PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]+(?:'[\p{L}0-9._%+-]+)*@(?:[\p{L}0-9-]+\.)+\p{L}{2,}",
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[a-z]{4})?(?: ?[0-9]{4}){2,6}(?: ?[0-9]{1,3})?)(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|[.][0-9]{1,2}[.])[0-9]{1,2}|[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|[.][0-9]{1,2}[.])[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{2})(?![0-9]|[-/.][0-9])",
    "ip6": r"(?<![\p{L}0-9:.])(?:(?:_HEX:){7}_HEX|(?:_HEX:){1,5}(?::_HEX){1,5}|(?:_HEX:){2,7}:)(?![\p{L}0-9:]|\.[0-9])".replace("_HEX", _HEX),
    "ip": r"(?<![\p{L}0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?:(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9-])(?<![0-9] )[0-9]{3} [0-9]{2} [0-9]{4}(?![0-9-]| [0-9]))",
    "card": r"(?<![0-9])(?:[0-9](?:[ -]?[0-9]){12,18}|[0-9]{4}(?:(?:\.[0-9]{4}){3}|(?:  [0-9]{4}){3}))(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])",
}
#: In place of two of them: all the groups that an IBAN or a card may share with its neighbours.
RUNS = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?:[ -][A-Z0-9]++(?![a-z]))*+(?![A-Za-z0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+",
}
_LONGEST = 43  # characters of an IBAN with its spaces
#: (first day, two factors of the number of days) of the dates with leading zeros, by the digits of their year.
_DAYS = {4: ("1800-01-01", 189, 773), 2: ("1969-01-01", 75, 487)}
_PASSES = 4  # of a network that changes one cell at a time


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """body with name bound to value, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _feistel(left: str, right: str, a: str, b: str, tweak: str, key: str) -> str:
    """struct<l, r>: a keyed permutation of pairs below (a, b). Each round adds a hash of one side to the other."""
    side = "cast(conv(substr(sha2(concat_ws(':', {key}, {tweak}, i, {x}), 256), 1, 14), 16, 10) as bigint)"
    to_left, to_right = side.format(key=_q(key), tweak=tweak, x="s.r"), side.format(key=_q(key), tweak=tweak, x="s.l")
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (s, i) -> if(i % 2 = 0, "
        f"named_struct('l', pmod(s.l + {to_left}, cast({a} as bigint)), 'r', s.r), named_struct('l', s.l, 'r', pmod(s.r + {to_right}, cast({b} as bigint)))))"
    )


def _cells(values: str, sizes: str, tweak: str, key: str) -> str:
    """array: a keyed permutation of arrays of numbers, each below its size. Each step adds a hash of all the others to one."""
    others = "concat_ws(',', transform(s, (x, k) -> if(k = i % size(s), '', cast(x as string))))"
    grown = f"cast(conv(substr(sha2(concat_ws(':', {_q(key)}, {tweak}, i, {others}), 256), 1, 14), 16, 10) as bigint)"
    step = f"transform(s, (x, k) -> if(k = i % size(s), pmod(x + {grown}, get({sizes}, k)), x))"
    return f"aggregate(sequence(0, {_PASSES} * size({values}) - 1), {values}, (s, i) -> {step})"


def _permute_digits(d: str, tweak: str, key: str) -> str:
    """A digit string of 2 to 30 digits, permuted among those of its length."""
    u = f"(length({d}) div 2)"
    v = f"(length({d}) - {u})"
    net = _feistel(f"substr({d}, 1, {u})", f"substr({d}, {u} + 1)", f"pow(10, {u})", f"pow(10, {v})", f"concat({tweak}, length({d}))", key)
    return _let("p", net, f"concat(lpad(cast(p.l as string), {u}, '0'), lpad(cast(p.r as string), {v}, '0'))")


def _permute_letters(y: str, tweak: str, key: str) -> str:
    """1 to 20 capital letters, permuted among those of their number."""
    u = f"(length({y}) div 2)"
    number = "cast(aggregate(split({}, ''), 0L, (z, c) -> if(c = '', z, z * 26 + ascii(c) - 65)) as bigint)"
    letters = "aggregate(sequence(1, {n}), named_struct('v', {v}, 'o', ''), (z, k) -> if(k > {n}, z, named_struct('v', z.v div 26, 'o', concat(char(65 + z.v % 26), z.o))), z -> z.o)"
    left, right = number.format(f"substr({y}, 1, {u})"), number.format(f"substr({y}, {u} + 1)")
    net = _feistel(left, right, f"pow(26, {u})", f"pow(26, length({y}) - {u})", f"concat({tweak}, length({y}))", key)
    first = f"if({u} = 0, '', {letters.format(n=u, v='p.l')})"
    return _let("p", net, f"concat({first}, {letters.format(n=f'(length({y}) - {u})', v='p.r')})")


def _fill(template: str, digits: str, first: str = "0", last: str = "9") -> str:
    """template with its digits, in order, replaced by those of digits (or characters between two others)."""
    step = f"if(c between '{first}' and '{last}', named_struct('o', concat(t.o, substr(t.d, t.k, 1)), 'k', t.k + 1, 'd', t.d), named_struct('o', concat(t.o, c), 'k', t.k, 'd', t.d))"
    return f"aggregate(split({template}, ''), named_struct('o', '', 'k', 1, 'd', {digits}), (t, c) -> {step}, t -> t.o)"


def _luhn(d: str) -> str:
    """Luhn sum of a digit string; valid if a multiple of 10."""
    digit = f"cast(substr({d}, length({d}) - n + 1, 1) as int)"
    return f"aggregate(sequence(1, length({d})), 0, (z, n) -> z + if(n % 2 = 1, {digit}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit})))"


def _mod97(text: str) -> str:
    """Remainder of the number that letters (A = 10) and digits spell."""
    return f"aggregate(split({text}, ''), 0, (z, c) -> if(c between '0' and '9', (z * 10 + cast(c as int)) % 97, if(c between 'A' and 'Z', (z * 100 + ascii(c) - 55) % 97, z)))"


def _with_date(m: str, body: str) -> str:
    """body with y (the whole year), n (month) and d (day) of the written date m as bigints, and w, its parts as written."""
    year = "if(length(get(w, 0)) = 4, get(w, 0), get(w, 2))"
    y = f"cast({year} as bigint) + if(length({year}) = 4, 0, if(cast({year} as int) > 68, 1900, 2000))"
    day = "cast(if(length(get(w, 0)) = 4, get(w, 2), get(w, 0)) as bigint)"
    return _let("w", f"split({m}, '[-/.]')", _let("y", y, _let("n", "cast(get(w, 1) as bigint)", _let("d", day, body))))


def _iso(y: str, n: str, d: str) -> str:
    return f"concat(lpad({y}, 4, '0'), '-', lpad({n}, 2, '0'), '-', lpad({d}, 2, '0'))"


def _valid_date(m: str) -> str:
    return f"coalesce({_with_date(m, f'y between 1800 and 2199 and try_to_timestamp({_iso("y", "n", "d")}, {_q("yyyy-MM-dd")}) is not null')}, false)"


def _new_date(key: str) -> str:
    """The pseudonym of the date m."""
    # with leading zeros: any day of the domain
    def padded(digits: int) -> str:
        first, a, b = _DAYS[digits]
        day = f"datediff(to_date({_iso('y', 'n', 'd')}), date{_q(first)})"
        return _let("p", _feistel(f"{day} div {b}", f"{day} % {b}", str(a), str(b), _q("date" + str(digits)), key), f"date_add(date{_q(first)}, cast(p.l * {b} + p.r as int))")

    short = f"date_format({padded(2)}, 'ddMMyy')"
    long = _let("t", padded(4), "if(length(get(w, 0)) = 4, date_format(t, 'yyyyMMdd'), date_format(t, 'ddMMyyyy'))")
    whole = _fill("m", f"if(length(get(w, 0)) < 4 and length(get(w, 2)) < 4, {short}, {long})")
    # without: month and day among those of as many digits, up to the 28th; later days keep all but their year
    low_n, months = "if(length(get(w, 1)) = 1, 1, if(n > 9, 10, 1))", "if(length(get(w, 1)) = 1, 9, if(n > 9, 3, 9))"
    one = "length(if(length(get(w, 0)) = 4, get(w, 2), get(w, 0))) = 1 or d < 10"
    low_d, days = f"if({one}, 1, 10)", f"if({one}, 9, 19)"
    tweak = f"concat('date', {low_n}, ':', {low_d})"
    some = _let("p", _feistel(f"(y - 1800) * {months} + n - {low_n}", f"d - {low_d}", f"400 * {months}", days, tweak, key), f"named_struct('y', 1800 + p.l div {months}, 'n', p.l % {months} + {low_n}, 'd', p.r + {low_d})")
    late = _let("p", _feistel("(y - 1800) div 20", "(y - 1800) % 20", "20", "20", "concat('year', n, ':', d)", key), "named_struct('y', 1800 + p.l * 20 + p.r, 'n', n, 'd', d)")
    kept = "named_struct('y', y, 'n', n, 'd', d)"
    sep = "substr(regexp_replace(m, '[0-9]', ''), 1, 1)"
    text = lambda x, part: f"lpad(cast({x} as string), greatest(length({part}), length(cast({x} as string))), '0')"
    ordered = f"if(length(get(w, 0)) = 4, concat(z.y, {sep}, {text('z.n', 'get(w, 1)')}, {sep}, {text('z.d', 'get(w, 2)')}), concat({text('z.d', 'get(w, 0)')}, {sep}, {text('z.n', 'get(w, 1)')}, {sep}, z.y))"
    loose = _let("z", f"if(d < 29, {some}, if(n = 2, {kept}, {late}))", ordered)
    zeros = "length(get(w, 1)) = 2 and least(length(get(w, 0)), length(get(w, 2))) = 2"
    return _with_date("m", f"if({zeros}, {whole}, {loose})")


def _pseudonyms(key: str) -> dict[str, tuple[str, str]]:
    """kind -> (validation, pseudonym) of the match m, whose digits are d."""
    octet = "cast(get(split(m, '[.]'), {}) as bigint)"
    high, low = (f"({octet.format(k)} * 256 + {octet.format(k + 1)})" for k in (0, 2))
    ip = _let("p", _feistel(high, low, "65536", "65536", "'ip'", key), "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)")
    area, group, serial = "cast(substr(d, 1, 3) as int)", "cast(substr(d, 4, 2) as int)", "cast(substr(d, 6, 4) as int)"
    ssn_left = f"(if({area} > 666, {area} - 2, {area} - 1) * 99 + {group} - 1)"
    ssn = _let("p", _feistel(ssn_left, f"{serial} - 1", "88902", "9999", "'ssn'", key), _let("w", "p.l div 99 + 1", _fill("m", "concat(lpad(cast(if(w > 665, w + 1, w) as string), 3, '0'), lpad(cast(p.l % 99 + 1 as string), 2, '0'), lpad(cast(p.r + 1 as string), 4, '0'))")))
    body = _permute_digits("substr(d, 1, length(d) - 1)", "'card'", key)
    card = _let("y", body, _fill("m", f"concat(y, cast((10 - {_luhn("concat(y, '0')")} % 10) % 10 as string))"))
    # the country code stays: what stands between + and the next sign, or two digits of it
    code = "case when m like '+%' then coalesce(nullif(length(regexp_extract(m, '^[+]([0-9]{1,3})[ .(-]', 1)), 0), 2) when d like '00%' then 4 else 0 end"
    own = "substr(d, length(d) - n + 1)"
    phone = _let("n", f"least(10, length(d) - {code})", _fill("m", f"concat(substr(d, 1, length(d) - n), {_permute_digits(own, "'phone'", key)})"))
    # IBAN: the digits and the letters after country and check digits are permuted, then the check digits computed anew
    tail = "regexp_replace(substr(m, 5), '[^0-9]', '')"
    moved = _let("y", tail, f"if(length(y) < 2, y, {_permute_digits('y', "'iban'", key)})")
    names = "regexp_replace(substr(m, 5), '[^A-Z]', '')"
    named = _let("y", names, f"if(length(y) between 1 and 20, {_permute_letters('y', "'ibanletters'", key)}, y)")
    iban = _let("f", _fill(_fill("substr(m, 5)", moved), named, "A", "Z"), f"concat(substr(m, 1, 2), lpad(cast(98 - {_mod97("concat(f, substr(m, 1, 2), '00')")} as string), 2, '0'), f)")
    # an IBAN in small letters is that in capitals, written small
    iban = _let("small", "m = lower(m)", _let("m", "upper(m)", _let("whole", iban, "if(small, lower(whole), whole)")))
    # e-mail: a cell for each character before the domain; signs are cells of size 1
    lower_ = "ascii(lower(x)) - 97 between 0 and 25 and ascii(x) < 128"
    of = lambda digit, letter, other, sign: f"case when x between '0' and '9' and ascii(x) < 128 then {digit} when {lower_} then {letter} when ascii(x) > 127 then {other} else {sign} end"
    sizes, values = (f"transform(c, x -> cast({of(*four)} as bigint))" for four in (("10", "26", "16", "1"), ("cast(x as int)", "ascii(lower(x)) - 97", "ascii(x) % 16", "0")))
    far = "decode(unhex(lpad(hex(cast(ascii(x) - ascii(x) % 16 + v as bigint)), 8, '0')), 'UTF-32')"
    spelt = of("cast(v as string)", "char(cast(v as int) + if(x = lower(x), 97, 65))", far, "x")
    name = _let("r", sizes, _let("u", values, _cells("u", "r", "concat('email', lower(substring_index(m, '@', -1)))", key)))
    email = _let("c", "filter(split(substring_index(m, '@', 1), ''), x -> x <> '')", f"concat(array_join(zip_with(c, {name}, (x, v) -> {spelt}), ''), '@', substring_index(m, '@', -1))")
    hexes = _let("r", "transform(c, x -> if(x = ':', 1L, 16L))", _let("u", "transform(c, x -> if(x = ':', 0L, cast(conv(x, 16, 10) as bigint)))", _cells("u", "r", "'ip6'", key)))
    ip6 = _let("c", "filter(split(m, ''), x -> x <> '')", f"array_join(zip_with(c, {hexes}, (x, v) -> if(x = ':', x, if(m = upper(m), hex(v), lower(hex(v))))), '')")
    return {
        "email": ("true", email),
        "iban": (f"{_mod97('upper(concat(substr(m, 5), substr(m, 1, 4)))')} = 1", iban),
        "date": (_valid_date("m"), _new_date(key)),
        "ip6": ("regexp(m, '[0-9]') and size(split(m, ':')) < 9", ip6),
        "ip": ("forall(split(m, '[.]'), o -> cast(o as int) <= 255)", ip),
        "ssn": (f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0", ssn),
        "card": (f"length(d) between 13 and 19 and {_luhn('d')} % 10 = 0", card),
        "phone": ("length(d) between 10 and 15 and (length(d) < 12 or regexp(m, '[^0-9]') or d like '00%')", phone),
    }


def _parted(text: str, mark: str, rules: dict[str, tuple[str, str]]) -> str:
    """text with mark between each valid IBAN or card and the groups that its run has before and after it."""
    valid = " or ".join(f"regexp(s, {_q('^(?:' + PATTERNS[k] + ')$')}) and {rules[k][0].replace('substr(m,', 'substr(s,')}" for k in ("iban", "card"))
    valid = _let("s", "substr(m, p, e - p + 1)", _let("d", "regexp_replace(s, '[^0-9]', '')", f"({valid})"))
    ends = f"filter(sequence(p + 11, least(length(m), p + {_LONGEST - 1})), e -> e = length(m) or substr(m, e + 1, 1) in (' ', '-'))"
    best = f"if(p + 11 > length(m), null, array_max(filter({ends}, e -> {valid})))"
    starts = "filter(sequence(1, length(m)), p -> p = 1 or substr(m, p - 1, 1) in (' ', '-'))"
    grown = f"named_struct('o', concat(z.o, substr(m, z.k, p - z.k), if(p > 1, {mark}, ''), substr(m, p, b - p + 1), if(b < length(m), {mark}, '')), 'k', b + 1)"
    run = f"aggregate({starts}, named_struct('o', '', 'k', 1), (z, p) -> if(p < z.k, z, {_let('b', best, f'if(b is null, z, {grown})')}), z -> concat(z.o, substr(m, z.k)))"
    pattern = _q("|".join(RUNS.get(k, PATTERNS[k]) for k in KINDS))
    whole = _q("^(?:" + "|".join(RUNS[k] for k in RUNS) + ")$")
    runs = f"transform(regexp_extract_all({text}, {pattern}, 0), m -> if(regexp(m, {whole}), {run}, m))"
    parted = f"array_join(zip_with(split({text}, {pattern}, -1), concat({runs}, array('')), (g, r) -> concat(g, r)), '')"
    return f"if(regexp({text}, {_q(PATTERNS['iban'] + '|' + RUNS['card'])}), {parted}, {text})"


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten and n_email ... n_phone, the findings of each kind (long)."""
    pattern = "|".join(PATTERNS[k] for k in KINDS)
    rules = _pseudonyms(key)
    kinds = " ".join(f"when regexp(m, {_q('^(?:' + PATTERNS[k] + ')$')}) and {rules[k][0]} then '{k}'" for k in KINDS)
    found = f"transform(regexp_extract_all(_text, {_q(pattern)}, 0), m -> {_let('d', "regexp_replace(m, '[^0-9]', '')", f"named_struct('m', m, 'd', d, 'kind', case {kinds} end)")})"
    new = " ".join(f"when '{k}' then {_let('m', 'x.m', _let('d', 'x.d', rules[k][1]))}" for k in KINDS)
    # a mark that no pattern takes in: the first noncharacter that the text does not hold
    marks = ", ".join(_q(chr(c)) for c in range(0xFDD0, 0xFDF0))
    df = packed(docs, source=F.col(text_col)).withColumn("_mark", F.expr(f"coalesce(get(filter(array({marks}), c -> not contains(source, c)), 0), '')"))
    df = df.withColumn("_text", F.expr(f"if(regexp(source, '[0-9]'), {_parted('source', '_mark', rules)}, source)"))
    # texts without a digit or an at sign hold none of the kinds
    df = df.withColumn("_found", F.expr(f"if(regexp(_text, '[0-9@]'), {found}, null)"))
    counts = {f"n_{k}": F.expr(f"if(_found is null, 0L, cast(size(filter(_found, x -> x.kind = '{k}')) as bigint))") for k in KINDS}
    df = df.withColumn("_new", F.expr(f"transform(_found, x -> case x.kind {new} else x.m end)"))
    gaps = f"split(_text, {_q(pattern)}, -1)"
    joined = f"replace(array_join(zip_with({gaps}, concat(_new, array('')), (g, r) -> concat(g, r)), ''), _mark, '')"
    text = f"if(_found is null or size(filter(_found, x -> x.kind is not null)) = 0, source, {joined})"
    return unpacked(df, docs.columns, **{text_col: F.expr(text)}, **counts)
