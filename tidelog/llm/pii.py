"""Personal data as format-preserving pseudonyms, in DataFrame and SQL functions only.

Numbers, dates, addresses and secrets found in texts are validated and then permuted within
their own format by a keyed Feistel network: a card number becomes another valid card number,
a date another date. Equal values get equal pseudonyms in all documents, different values different
ones (but see ``slash_date``), and who has the key can go back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"

# The forms looked for, in order of preference.
_NUM = "(?<![0-9A-Za-z])"
_END = "(?![0-9A-Za-z])"
# characters of an IBAN by country, as registered or in use
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# In groups of four a value ends where its country says, not with the word that follows; others take all there is.
_IBAN_GROUPS = "|".join(
    f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") + _END
    for n, countries in IBAN_COUNTRIES.items()
)
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?[\"']?[A-Za-z0-9+/_-]{8,128}(?![A-Za-z0-9])",
    "access_key": _NUM + "AKIA[0-9A-Z]{16}" + _END,
    "iban": _NUM + f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN_GROUPS}|[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?){_END})",
    "iso_date": r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-SU-Za-su-z]|[Tt](?![0-9])|-[0-9])",
    "slash_date": r"(?<![0-9A-Za-z/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9A-Za-z]|/[0-9])",
    "dot_date": r"(?<![0-9A-Za-z.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9A-Za-z]|\.[0-9])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}|(?:\+1[ .-])?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3})" + _END,
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": _NUM + "(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _END,
}
ANY_FORM = "|".join(f"(?:{f})" for f in FORMS.values())


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _feistel(values: str, radices: str, tweak: str) -> str:
    """SQL: an array of numbers, each below its radix, permuted among all such arrays.

    The array is cut in two halves. In turn each half is shifted, number by number, by a
    keyed hash of the other one, which can be undone round by round.
    """

    def moved(half: str, other: str, radix: str) -> str:
        said = f"concat_ws('|', llm_key, {tweak}, r, i, array_join({other}, ','))"
        number = f"cast(conv(substring(sha2({said}, 256), 1, 15), 16, 10) as bigint)"
        return f"transform({half}, (v, i) -> pmod(v + {number}, element_at({radix}, cast(i + 1 as int))))"

    half = "cast(floor(size(vs) / 2) as int)"
    rest = f"size(vs) - {half}"
    start = f"named_struct('x', slice(vs, 1, {half}), 'y', slice(vs, 1 + {half}, {rest}))"
    step = (
        f"if(r % 2 = 0, named_struct('x', {moved('s.x', 's.y', f'slice(ms, 1, {half})')}, 'y', s.y),"
        f" named_struct('x', s.x, 'y', {moved('s.y', 's.x', f'slice(ms, 1 + {half}, {rest})')}))"
    )
    walk = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {step}, s -> concat(s.x, s.y))"
    return _let("vs", f"transform({values}, v -> cast(v as bigint))", _let("ms", f"transform({radices}, v -> cast(v as bigint))", walk))


def _chars(text: str) -> str:
    return f"transform(sequence(1, length({text})), i -> substring({text}, i, 1))"


def _permuted(text: str, alphabets: str, tweak: str) -> str:
    """SQL: a text of at least one character, each of which stays in its alphabet."""
    values = "zip_with(cs, al, (c, a) -> locate(c, a) - 1)"
    made = _feistel(values, "transform(al, a -> length(a))", tweak)
    joined = _let("made", made, "array_join(zip_with(al, made, (a, v) -> substring(a, cast(v + 1 as int), 1)), '')")
    return _let("cs", _chars(text), _let("al", f"transform(cs, c -> {alphabets})", joined))


_CLASSES = f"case when c rlike '[0-9]' then '{DIGITS}' when c rlike '[a-z]' then '{LOWER}' when c rlike '[A-Z]' then '{LOWER.upper()}' else c end"


def _spread(template: str, kept: str, chars: str) -> str:
    """SQL: ``template`` with its characters of class ``kept`` replaced, in order, by ``chars``."""
    place = f"length(regexp_replace(substring({template}, 1, i), '[^{kept}]', ''))"
    one = f"if(substring({template}, i, 1) rlike '[{kept}]', substring({chars}, {place}, 1), substring({template}, i, 1))"
    return f"array_join(transform(sequence(1, length({template})), i -> {one}), '')"


def _luhn(digits: str, doubled: int) -> str:
    """SQL: the weighted sum of digits, counted from the right; every second one is doubled."""
    d = f"cast(substring({digits}, length({digits}) - i + 1, 1) as int)"
    twice = f"if({d} > 4, 2 * {d} - 9, 2 * {d})"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = {doubled}, {twice}, {d}))"


def _mod97(text: str) -> str:
    """SQL: the number an IBAN stands for, its letters as 10 to 35, modulo 97."""
    step = "if(c rlike '[0-9]', (s * 10 + ascii(c) - 48) % 97, (s * 100 + ascii(c) - 55) % 97)"
    return f"aggregate({_chars(text)}, 0, (s, c) -> cast({step} as int))"


def _email(t: str) -> str:
    local = f"substring_index({t}, '@', 1)"
    return f"concat({_permuted(local, _CLASSES, _text('email'))}, '@', substring_index({t}, '@', -1))"


def _secret(t: str) -> str:
    head = r"^(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?[\"\']?"
    value = f"regexp_replace({t}, {_text(head)}, '')"
    alphabets = f"if(value rlike '^[0-9a-f]+$', '{HEX}', {_CLASSES})"
    return _let("value", value, f"concat(substring({t}, 1, length({t}) - length(value)), {_permuted('value', alphabets, _text('secret'))})")


def _access_key(t: str) -> str:
    return f"concat('AKIA', {_permuted(f'substring({t}, 5)', f'\'{LOWER.upper()}{DIGITS}\'', _text('access_key'))})"


def _iban(t: str) -> str:
    plain = f"replace({t}, ' ', '')"
    body = _permuted("substring(plain, 5)", _CLASSES, "concat('iban', substring(plain, 1, 2))")
    check = f"lpad(cast(98 - {_mod97('concat(body, substring(plain, 1, 2), \'00\')')} as string), 2, '0')"
    made = _let("body", body, _let("made", f"concat(substring(plain, 1, 2), {check}, body)", _spread(t, "A-Z0-9", "made")))
    valid = f"length(plain) between 15 and 34 and {_mod97('concat(substring(plain, 5), substring(plain, 1, 4))')} = 1"
    return _let("plain", plain, f"if({valid}, {made}, null)")


# 200 years are 73,049 = 17 * 4,297 days.
_FIRST_DAY, _DAYS = "date'1900-01-01'", (17, 4297)


def _date(year: str, month: str, day: str, form: str) -> str:
    y, m, d = (f"cast({x} as int)" for x in (year, month, day))
    valid = f"{y} between 1900 and 2099 and {m} between 1 and 12 and {d} >= 1"
    within = f"{d} <= day(last_day(make_date({y}, {m}, 1)))"
    number = f"datediff(make_date({y}, {m}, {d}), {_FIRST_DAY})"
    values = f"array(n div {_DAYS[1]}, n % {_DAYS[1]})"
    made = _let("n", number, _feistel(values, f"array({_DAYS[0]}, {_DAYS[1]})", _text("date")))
    new = _let("p", made, f"date_format(date_add({_FIRST_DAY}, cast(p[0] * {_DAYS[1]} + p[1] as int)), '{form}')")
    return f"case when {valid} then case when {within} then {new} end end"


def _ip(t: str) -> str:
    made = _feistel("parts", "array(256, 256, 256, 256)", _text("ip"))
    parts = f"transform(split({t}, '[.]'), x -> cast(x as int))"
    return _let("parts", parts, f"if(array_max(parts) < 256, array_join({made}, '.'), null)")


def _phone(t: str) -> str:
    head = f"regexp_extract({t}, '^[+][0-9]{{1,3}}(?=[ (.-])', 0)"
    rest = f"substring({t}, length(head) + 1)"
    digits = _let("digits", "regexp_replace(rest, '[^0-9]', '')", f"if(length(digits) between 7 and 15, {_let('made', _permuted('digits', f'\'{DIGITS}\'', _text('phone')), 'concat(head, ' + _spread('rest', '0-9', 'made') + ')')}, null)")
    return _let("head", head, _let("rest", rest, digits))


def _ssn(t: str) -> str:
    area, group, serial = (f"cast(substring({t}, {a}, {n}) as int)" for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    # 898 areas, as 666 is none
    values = f"array({area} - if({area} > 666, 2, 1), {group} - 1, {serial} - 1)"
    back = "p[0] + if(p[0] >= 665, 2, 1)"
    made = _let("p", _feistel(values, "array(898, 99, 9999)", _text("ssn")), f"concat_ws('-', lpad({back}, 3, '0'), lpad(p[1] + 1, 2, '0'), lpad(p[2] + 1, 4, '0'))")
    return f"if({valid}, {made}, null)"


def _card(t: str) -> str:
    body = _permuted("substring(digits, 1, length(digits) - 1)", f"'{DIGITS}'", _text("card"))
    check = f"cast((10 - {_luhn('body', 1)} % 10) % 10 as string)"
    made = _let("body", body, _let("made", f"concat(body, {check})", _spread(t, "0-9", "made")))
    valid = f"length(digits) between 13 and 19 and {_luhn('digits', 0)} % 10 = 0"
    return _let("digits", f"regexp_replace({t}, '[^0-9]', '')", f"if({valid}, {made}, null)")


def _pseudonym(t: str) -> str:
    """SQL: the pseudonym of a match, or null if it is no valid value of any form."""
    part = lambda a, n: f"substring({t}, {a}, {n})"
    made = {
        "email": _email(t),
        "secret": _secret(t),
        "access_key": _access_key(t),
        "iban": _iban(t),
        "iso_date": _date(part(1, 4), part(6, 2), part(9, 2), "yyyy-MM-dd"),
        "slash_date": f"coalesce({_date(part(7, 4), part(4, 2), part(1, 2), 'dd/MM/yyyy')}, {_date(part(7, 4), part(1, 2), part(4, 2), 'MM/dd/yyyy')})",
        "dot_date": _date(part(7, 4), part(4, 2), part(1, 2), "dd.MM.yyyy"),
        "ip": _ip(t),
        "phone": _phone(t),
        "ssn": _ssn(t),
        "card": _card(t),
    }
    cases = " ".join(f"when {t} rlike {_text(f'^(?:{FORMS[kind]})$')} then {sql}" for kind, sql in made.items())
    return f"case {cases} end"


def pseudonyms(docs: DataFrame, text: str, key: str, new_text: str = "text", count: str = "n_replaced") -> DataFrame:
    """``docs`` with personal values replaced in ``text``, as ``new_text``, and their number as ``count``.

    Matches are validated first: cards by Luhn's sum, IBANs by their check number, dates by the
    calendar (1900 to 2099), addresses by their bytes, social security numbers by
    the numbers in use, telephone numbers by 7 to 15 digits; what is not valid stays. Slash dates are read as
    day/month where that is a date, else as month/day. Null texts stay null and count 0.
    All other columns stay as they are, but for those named ``new_text`` or ``count``.
    """
    found = F.col(f"`{text}`").rlike("[0-9@=:]|AKIA")
    values = F.expr(f"transform(llm_found, t -> named_struct('old', t, 'new', {_pseudonym('t')}))")
    joined = F.expr("array_join(flatten(zip_with(llm_parts, llm_values, (p, v) -> array(p, coalesce(v.new, v.old, '')))), '')")
    columns = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("llm_row"), F.col(f"`{text}`").alias("llm_text"), found.alias("llm_any"), F.lit(key).alias("llm_key"))
    rows = rows.select(
        "llm_row",
        "llm_text",
        "llm_key",
        F.when(F.col("llm_any"), F.regexp_extract_all("llm_text", F.lit(ANY_FORM), F.lit(0))).alias("llm_found"),
    )
    some = F.size("llm_found") > 0
    rows = rows.withColumn("llm_values", F.when(some, values)).withColumn("llm_parts", F.when(some, F.split("llm_text", ANY_FORM, -1)))
    out = {
        new_text: F.when(some, joined).otherwise(F.col("llm_text")),
        count: F.when(some, F.expr("size(filter(llm_values, v -> v.new is not null))")).otherwise(0).cast("bigint"),
    }
    kept = [out.pop(c).alias(c) if c in out else F.col("llm_row").getField(c).alias(c) for c in columns]
    return rows.select(*kept, *(v.alias(c) for c, v in out.items()))
