"""Surrogates for personal data, with built-in functions only.

Entities (addresses of mail and network, telephone, card, account and social-security numbers, titled
names) are found by one pattern in one pass; in a text with titled names, further mentions of the same name
words, capital first, are replaced alike. Each entity is brought to a canonical form (case and punctuation don't
tell two mentions apart, and a name goes word by word), and its surrogate depends on the key, the kind and the
canonical form alone, so all mentions in all documents stay together. Letters become letters of the same script
and case (Latin and Cyrillic ones of the same kind, vowel or consonant; others of the same code-point block),
digits digits, and punctuation stays; country codes, top domains, the first digit of a card and a name's last
letter, which tells gender in many languages, stay; card and account numbers get valid check digits where they
had them; known given names become given names of the same gender and script; a title before a name stays.

Surrogates are distinct by construction, however full a form's space is: each form (the kinds of characters, in
order) is mapped on itself by a keyed permutation. A character moves within its alphabet by a step that depends on
its place and the ``WINDOW`` characters before it, so the first character where two entities differ tells their
surrogates apart, and none equals its own entity; a check digit keeps its distance from the valid one; given names
turn in a circle, and a name that would become one of them is moved on until it is none. ``pseudonymize`` checks
it: the replaced table is written with its pairs of entity and surrogate, a grouped aggregate looks for a surrogate
of two entities, and one would be an error. A surrogate may be another entity's real form, as in every permutation.

Defined results: null texts stay null with no entities; empty texts stay empty; repeated rows and ties are alike; an
empty table gives no rows; texts and entities of any length take time in proportion to it. All other columns are
kept, whatever their names; a column of the name ``out`` is replaced, and one word of a single letter moves whole.
"""

from __future__ import annotations

import hashlib
import hmac
import unicodedata
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, quoted, written

#: The characters before it that a character's step depends on.
WINDOW = 16

#: Given names by script and gender, titles, and letters (fixed values).
GIVEN = {
    "latin-m": "adam albert andrew anthony arthur brian carlos charles daniel david dieter edward eric felix frank george hans henri henry hugo ivan jack jacques james jean john jose juan julius karl kevin klaus lars leo louis luis marc mark martin michael miguel oscar otto paul pedro peter philip pierre ralph richard robert roger simon stefan steven thomas victor walter werner william".split(),
    "latin-f": "agnes alice amelie amy anna barbara beatrice brigitte camille carla carmen caroline catherine charlotte claire clara diana dora elena elisabeth elizabeth ella emily emma erika eva fiona frida gisela grace hannah heidi helen helga ines irene isabel jane jennifer juana julia karen katrin laura linda lisa louise lucia margaret maria marie martha mary nina olga patricia paula renate rosa ruth sarah sofia susan ursula".split(),
    "cyrillic-m": "алексей андрей борис виктор владимир дмитрий иван игорь михаил николай олег павел пётр сергей юрий".split(),
    "cyrillic-f": "анна вера галина елена ирина лариса людмила мария надежда наталья ольга светлана софья татьяна юлия".split(),
}
TITLES = "Mrs|Mr|Ms|Miss|Herr|Frau|Mme|Mlle|Monsieur|Madame|Señora|Señor|Sra|Sr|Doña|Don|г-жа|г-н"
ALPHABETS = ["0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ", "àâäáåæèéêëìíîïòóôöøœùúûü", "çñßð", "ÀÂÄÁÅÆÈÉÊËÌÍÎÏÒÓÔÖØŒÙÚÛÜ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ"]

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERN = "|".join([
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w])",
    r"(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)",
    r"(?<![\w+.-])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])",
    r"(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    rf"(?<![\p{{L}}\p{{N}}])(?:{TITLES})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+){{0,2}}",
])
#: What a text must have for any entity, by a cheaper search: a mail address an at sign, a number a digit, a name a title.
TITLED = rf"(?=[{''.join(sorted({t[0] for t in TITLES.split('|')}))}])(?:{TITLES})\.? \p{{Lu}}"
#: A word that may be a further mention.
MENTION = r"(?<![\p{L}\p{N}])\p{Lu}\p{L}*+(?:['’-]\p{L}++)*+(?![\p{L}\p{N}])"
#: Stands between the parts of a text while it is cut.
MARK = "\x01"
#: What a name's word may end in besides the name itself.
_ENDING = r"(?<=\p{L}\p{L})(?:['’][sS]|['’-]+)$"
KINDS = ("email", "ip", "ssn", "iban", "card", "digits", "phone", "name")


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(e: str) -> str:
    return f"regexp_replace({e}, '[^0-9]', '')"


def _luhn(s: str, n: str) -> str:
    """The check digit that belongs at place n of a string of digits."""
    d = f"cast(substr({s}, li, 1) as int)"
    double = f"if({d} > 4, 2 * {d} - 9, 2 * {d})"
    total = f"aggregate(transform(sequence(1, {n} - 1), li -> if(({n} - li) % 2 = 1, {double}, {d})), 0, (lx, ly) -> lx + ly)"
    return f"cast((10 - {total} % 10) % 10 as string)"


def _mod97(s: str) -> str:
    """The remainder by 97 of letters and digits, letters as 10 to 35."""
    c = f"substr({s}, mi, 1)"
    value = f"if({c} rlike '[0-9]', cast({c} as int), ascii({c}) - 55)"
    return f"aggregate(transform(sequence(1, length({s})), mi -> {value}), 0, (mx, my) -> (mx * if(my > 9, 100, 10) + my) % 97)"


def kind_of(e: str) -> str:
    """SQL for the kind of an entity."""
    d = _digits(e)
    return (
        f"case when instr({e}, '@') > 0 then 'email'"
        f" when {e} rlike '^[0-9]+([.][0-9]+){{3}}$' then 'ip'"
        f" when {e} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 'ssn'"
        f" when {e} rlike '^[A-Z]{{2}}[0-9]{{2}}' then 'iban'"
        f" when {e} rlike '^([0-9][ -]?){{12,18}}[0-9]$' then if({_luhn(d, f'length({d})')} = right({d}, 1), 'card', 'digits')"
        f" when {e} rlike '^[+(0-9]' then 'phone' else 'name' end"
    )


def _canonical(e: str, kind: str) -> str:
    """SQL for the canonical form: of a telephone number its last ten digits."""
    return (
        f"case {kind} when 'email' then lower({e}) when 'ip' then {e}"
        f" when 'iban' then replace({e}, ' ', '') when 'name' then lower({e})"
        f" when 'phone' then right({_digits(e)}, 10) else {_digits(e)} end"
    )


def _bare(word: str) -> str:
    """SQL for a name's word without a possessive ending."""
    return f"regexp_replace({word}, {_q(_ENDING)}, '')"


def _name_words(e: str) -> str:
    """SQL for the words of a name without its title; a further mention is a word without one."""
    words = f"split({e}, ' ')"
    return f"transform(filter({words}, (nw, ni) -> ni > 0 or size({words}) = 1), nb -> {_bare('nb')})"


def _chars(e: str) -> str:
    """SQL for the characters of a string."""
    return f"regexp_extract_all({e}, '(?s).', 0)"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with a name for a value that it uses more than once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _given(key: str) -> dict[str, str]:
    """Each given name's own replacement: a keyed order of its list, moved on by one."""
    out = {}
    for group, names in GIVEN.items():
        order = sorted(names, key=lambda n: hmac.new(key.encode(), f"{group}|{n}".encode(), hashlib.sha256).digest())
        out |= dict(zip(order, order[1:] + order[:1], strict=True))
    return out


@cache
def _letters() -> tuple[tuple[str, ...], tuple[tuple[int, int], ...]]:
    """Alphabets of all letters and numbers outside of ALPHABETS, by script, block of 128 and case; runs of
    64 or more, such as CJK and Hangul, are ranges of code points. Fewer than four join their script."""
    known, runs, groups = set("".join(ALPHABETS)), [], {}
    for code in range(128, 0x110000):
        c = chr(code)
        what = unicodedata.category(c)
        if what[0] not in "LN" or c in known:
            continue
        if what in ("Ll", "Lu", "Lt"):  # of the lower-case ones, those that upper() and lower() give back stay apart
            what += "" if len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c else "-"
        group = (unicodedata.name(c, "OTHER").split("-")[0].split()[0], what)
        if runs and runs[-1][0] == group and runs[-1][2] == code - 1:
            runs[-1][2] = code
        else:
            runs.append([group, code, code])
    for group, low, high in runs:
        if high - low < 63:
            for code in range(low, high + 1):
                groups.setdefault((*group, code >> 7), []).append(chr(code))
    small = {}
    for k in [k for k, v in groups.items() if len(v) < 4]:
        small.setdefault(k[:2], []).extend(groups.pop(k))
    rest = [v for v in small.values() if len(v) < 4]
    alphabets = [*groups.values(), *(v for v in small.values() if len(v) >= 4), [c for v in rest for c in v]]
    return tuple("".join(v) for v in alphabets if len(v) > 1), tuple((a, b) for _, a, b in runs if b - a >= 63)


def _other_letter(c: str, k: str) -> str:
    """SQL for the substitution of a letter or number outside of ALPHABETS."""
    alphabets, ranges = _letters()
    own = f"get(filter(array({', '.join(map(_q, alphabets))}), la -> instr(la, {c}) > 0), 0)"
    span = f"get(filter(array({', '.join(f'struct({a} as a, {b - a + 1} as n)' for a, b in ranges)}), lr -> ascii({c}) between lr.a and lr.a + lr.n - 1), 0)"
    code = f"lv.a + pmod(ascii({c}) - lv.a + 1 + pmod({k}, lv.n - 1), lv.n)"
    char = f"decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32')"
    # letters newer than this Python's tables become Latin ones
    far = f"transform(array({span}), lv -> if(lv is null, substr({_q(ALPHABETS[2])}, 1 + pmod({k}, {len(ALPHABETS[2])}), 1), {char}))[0]"
    return f"transform(array({own}), lo -> if(lo is null, {far}, substr(lo, 1 + pmod(instr(lo, {c}) + pmod({k}, length(lo) - 1), length(lo)), 1)))[0]"


def _number(key: str, *parts: str) -> str:
    """SQL for a keyed number of 32 bits."""
    return f"cast(conv(substr(sha2(concat_ws('|', {_q(key)}, {', '.join(parts)}), 256), 1, 8), 16, 10) as bigint)"


def _shifted(kind: str, canon: str, key: str) -> str:
    """SQL for the keyed permutation of a canonical form, in place; numbers of 13 to 19 digits have one."""
    same = f"if({kind} = 'digits', 'card', {kind})"
    keyed = _number(key, same, "ci", f"array_join(slice(cz.c, greatest(1, ci - {WINDOW - 1}), least(ci, {WINDOW})), '')")
    keep = (
        "case cz.k when 'card' then ci = 0 or ci = size(cz.c) - 1 when 'iban' then ci < 4 when 'name' then ci = size(cz.c) - 1 and ci > 1"
        " when 'email' then ci >= size(cz.c) - cz.tail else false end"
    )
    cells = f"transform(cz.c, (cc, ci) -> named_struct('c', cc, 'k', {keyed}, 'keep', {keep}, 'lead', cz.k = 'phone' and ci = 0))"
    cases = ["when cx.keep or (cx.lead and cx.c < '2') then cx.c when cx.lead then substr('23456789', 1 + pmod(instr('23456789', cx.c) + pmod(cx.k, 7), 8), 1)"]
    for letters in ALPHABETS:
        at = f"instr({_q(letters)}, cx.c)"
        cases.append(f"when {at} > 0 then substr({_q(letters)}, 1 + pmod({at} + pmod(cx.k, {len(letters) - 1}), {len(letters)}), 1)")
    cases.append(f"when cx.c rlike '[\\\\p{{L}}\\\\p{{N}}]' then {_other_letter('cx.c', 'cx.k')}")
    tail = f"length(substring_index({canon}, '.', -1))"
    return _let("cz", f"named_struct('c', {_chars(canon)}, 'k', {same}, 'tail', {tail})", f"array_join(transform({cells}, cx -> case {' '.join(cases)} else cx.c end), '')")


def _octets(canon: str, key: str) -> str:
    """SQL for an address of four numbers: each moves within the numbers of as many digits."""
    cells = f"transform(split({canon}, '[.]'), (ov, oi) -> named_struct('v', cast(ov as int), 'k', {_number(key, _q('ip'), f"array_join(slice(split({canon}, '[.]'), 1, oi), '.')")}))"
    move = lambda low, n: f"{low} + pmod(ox.v - {low} + 1 + pmod(ox.k, {n - 1}), {n})"
    return f"array_join(transform({cells}, ox -> cast(case when ox.v < 10 then {move(0, 10)} when ox.v < 100 then {move(10, 90)} else {move(100, 156)} end as string)), '.')"


def name_surrogate(canon: str, key: str) -> str:
    """SQL for a name word's surrogate: its place in the circle of its given names, or the permutation, moved on
    while it meets one of them. A cycle leaves the given names after as many steps as there are, at the latest."""
    given = _given(key)
    names = f"map({', '.join(f'{_q(k)}, {_q(v)}' for k, v in given.items())})"
    known = f"array({', '.join(map(_q, given))})"
    on = f"aggregate(sequence(1, {len(given)}), wf, (wa, wi) -> if(array_contains({known}, wa), {_shifted(_q('name'), 'wa', key)}, wa))"
    walked = _let("wf", _shifted(_q("name"), canon, key), f"if(array_contains({known}, wf), {on}, wf)")
    return f"coalesce(element_at({names}, {canon}), {walked})"


def surrogate(kind: str, canon: str, key: str) -> str:
    """SQL for the surrogate of a canonical form other than a name's word, canonical itself."""
    check = f"pmod(cast(right({canon}, 1) as int) - cast({_luhn(canon, f'length({canon})')} as int) + cast({_luhn('sv', 'length(sv)')} as int), 10)"
    card = f"concat(left(sv, length(sv) - 1), cast({check} as string))"
    valid = lambda e: f"(98 - {_mod97(f'concat(substr({e}, 5), left({e}, 2), {_q('00')})')})"
    two = f"pmod(cast(substr({canon}, 3, 2) as int) - {valid(canon)} + {valid('sv')}, 100)"
    iban = f"concat(left(sv, 2), lpad(cast({two} as string), 2, '0'), substr(sv, 5))"
    drawn = f"case when {kind} in ('card', 'digits') then {card} when {kind} = 'iban' then {iban} else sv end"
    return f"case when {kind} = 'ip' then {_octets(canon, key)} else {_let('sv', _shifted(kind, canon, key), drawn)} end"


def _cased(e: str, s: str) -> str:
    """SQL for a surrogate in the case of a mention."""
    return (
        f"case when length({e}) = length({s}) then array_join(zip_with({_chars(e)}, {_chars(s)}, (de, ds) -> if(lower(de) <> de, upper(ds), ds)), '')"
        f" when lower({e}) = {e} then {s} when upper({e}) = {e} then upper({s}) else concat(upper(left({s}, 1)), substr({s}, 2)) end"
    )


def _dressed(e: str, s: str, kind: str) -> str:
    """SQL for a canonical surrogate in the form of the mention: its punctuation and its case."""
    digit = f"substr({e}, di, 1) rlike '[0-9]'"
    place = f"length({_digits(f'substr({e}, 1, di)')}) - (length({_digits(e)}) - length({s}))"
    numbers = f"array_join(transform(sequence(1, length({e})), di -> if({digit} and {place} > 0, substr({s}, {place}, 1), substr({e}, di, 1))), '')"
    blank = f"length(replace(substr({e}, 1, di), ' ', ''))"
    spaced = f"array_join(transform(sequence(1, length({e})), di -> if(substr({e}, di, 1) = ' ', ' ', substr({s}, {blank}, 1))), '')"
    return f"case {kind} when 'email' then {_cased(e, s)} when 'ip' then {s} when 'iban' then {spaced} else {numbers} end"


def _parts(e: str, pattern: str) -> str:
    """SQL for a text's parts: those at odd places (from 0) match the pattern."""
    fast = f"split(regexp_replace({e}, {_q(pattern)}, '{MARK}$0{MARK}'), '{MARK}', -1)"
    slow = f"zip_with(split({e}, {_q(pattern)}, -1), concat(regexp_extract_all({e}, {_q(pattern)}, 0), array(null)), (pg, pm) -> array(pg, pm))"
    return f"if(instr({e}, '{MARK}') = 0, {fast}, filter(flatten({slow}), pn -> pn is not null))"


ATOM = "struct<kind:string,canon:string,surr:string>"


def _word(w: str, key: str) -> str:
    """SQL for the struct<w, a> of a name's word: what it becomes, and its atom."""
    made = f"named_struct('w', concat({_cased('wb', 'vs')}, substr({w}, length(wb) + 1)), 'a', array(named_struct('kind', 'name', 'canon', lower(wb), 'surr', vs)))"
    return _let("wb", _bare(w), _let("vs", name_surrogate("lower(wb)", key), made))


def _pieces(key: str, parts: str, names: str) -> str:
    """SQL for the array of struct<s, k, a> of a text's parts: the new text, the kinds and the atoms in it."""
    nothing = f"cast(array() as array<{ATOM}>)"
    same = lambda w: f"named_struct('w', {w}, 'a', {nothing})"
    # a title stays, unless it is a word of a name too, as in 'Mr. Don Juan'
    title = f"wi = 0 and instr(pe, ' ') > 0 and not array_contains({names}, lower(wd))"
    words = f"transform(split(pe, ' '), (wd, wi) -> if({title}, {same('wd')}, {_word('wd', key)}))"
    name = _let("ws", words, "named_struct('s', array_join(transform(ws, wx -> wx.w), ' '), 'k', array('name'), 'a', flatten(transform(ws, wx -> wx.a)))")
    other = _let(
        "va", f"named_struct('kind', ek, 'canon', {_canonical('pe', 'ek')})",
        _let("vs", surrogate("va.kind", "va.canon", key), f"named_struct('s', {_dressed('pe', 'vs', 'va.kind')}, 'k', array(va.kind), 'a', array(named_struct('kind', va.kind, 'canon', va.canon, 'surr', vs)))"),
    )
    entity = _let("ek", kind_of("pe"), f"if(ek = 'name', {name}, {other})")
    known = f"array_contains({names}, lower({_bare('mw')}))"
    halves = f"transform(split(mw, {_q("(?<=['’-])|(?=['’-])")}), mh -> if(array_contains({names}, lower(mh)) and mh rlike {_q(r'^\p{Lu}')}, {_word('mh', key)}, {same('mh')}))"
    joined = _let("mj", halves, "named_struct('w', array_join(transform(mj, mx -> mx.w), ''), 'a', flatten(transform(mj, mx -> mx.a)))")
    mention = f"case when mi % 2 = 0 then {same('mw')} when {known} then {_word('mw', key)} when mw rlike {_q("['’-]")} then {joined} else {same('mw')} end"
    mentions = _let(
        "ms", f"transform({_parts('pe', MENTION)}, (mw, mi) -> {mention})",
        _let("ma", "flatten(transform(ms, mx -> mx.a))", "named_struct('s', array_join(transform(ms, mx -> mx.w), ''), 'k', transform(ma, mx -> mx.kind), 'a', ma)"),
    )
    gap = f"if(size({names}) > 0, {mentions}, named_struct('s', pe, 'k', cast(array() as array<string>), 'a', {nothing}))"
    return f"transform({parts}, (pe, pi) -> if(pi % 2 = 1, {entity}, {gap}))"


def replaced(df: DataFrame, key: str, text: str = "text", out: str = "pii", atoms: str | None = None) -> DataFrame:
    """Replaces the personal data in ``text``; adds array<string> ``out`` with the kind of each entity and, where
    it is named, ``atoms`` with the (kind, canon, surr) of each."""
    parts, names, pieces = free_names(df, "parts", "names", "pieces")
    t = quoted(text)
    may = f"contains({t}, '@') or {t} rlike '[0-9]' or {t} rlike {_q(TITLED)}"
    found = df.withColumn(parts, F.expr(f"if({may}, {_parts(t, PATTERN)}, array({t}))"))
    titled = f"filter({parts}, (fe, fi) -> fi % 2 = 1 and ({kind_of('fe')}) = 'name')"
    words = f"array_distinct(flatten(transform({titled}, et -> transform({_name_words('et')}, ew -> lower(ew)))))"
    found = found.withColumn(names, F.expr(f"if(size({parts}) > 1, {words}, cast(array() as array<string>))"))
    found = found.withColumn(pieces, F.expr(f"if(size({parts}) > 1, {_pieces(key, parts, names)}, null)"))
    new = {
        text: F.expr(f"if({pieces} is null, {t}, array_join(transform({pieces}, px -> px.s), ''))"),
        out: F.expr(f"coalesce(flatten(transform({pieces}, px -> px.k)), cast(array() as array<string>))"),
    }
    if atoms:
        new[atoms] = F.expr(f"coalesce(flatten(transform({pieces}, px -> px.a)), cast(array() as array<{ATOM}>))")
    kept = [c for c in df.columns if c not in new]
    order = [c for c in df.columns if c not in (out, atoms)] + [c for c in (out, atoms) if c]
    return found.select(*[F.col(quoted(c)) if c in kept else new[c].alias(c) for c in order])


def clashes(atoms: DataFrame) -> DataFrame:
    """(kind, surr, one, other) of surrogates that rows (kind, canon, surr) give two entities: none, unless the
    permutations are broken. Numbers of cards and of 13 to 19 digits are of one kind here."""
    scope = F.when(F.col("kind") == "digits", "card").otherwise(F.col("kind")).alias("kind")
    return atoms.groupBy(scope, "surr").agg(F.min("canon").alias("one"), F.max("canon").alias("other")).filter("one <> other")


def pseudonymize(df: DataFrame, key: str, text: str = "text", out: str = "pii") -> DataFrame:
    """``replaced``, written and read back, after the check that no two entities share a surrogate."""
    (atoms,) = free_names(df, "atoms")
    made, _ = written(replaced(df, key, text, out, atoms), "surrogates")
    found = clashes(made.select(F.explode(atoms).alias("a")).select("a.*")).head(1)
    if found:
        raise ValueError(f"two entities of kind {found[0].kind} share a surrogate")
    return made.drop(atoms)
