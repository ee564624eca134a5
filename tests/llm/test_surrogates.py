"""Surrogates against plain code: all kinds, distinctness, coreference, and texts of extreme shape."""

from __future__ import annotations

import hashlib
import random
import string

import regex
from pyspark.sql import functions as F

from skeinwright.llm import surrogates as s

KEY = "k7"
FIND = regex.compile(s.PATTERN)
WORD = regex.compile(s.MENTION)


def number(*parts: str) -> int:
    return int(hashlib.sha256("|".join([KEY, *parts]).encode()).hexdigest()[:8], 16)


def luhn(digits: str) -> int:
    """The last digit that makes the number valid."""
    total = sum(sum(divmod(int(c) * (2 if i % 2 == 0 else 1), 10)) for i, c in enumerate(reversed(digits[:-1])))
    return -total % 10


def mod97(e: str) -> int:
    return int("".join(str(int(c, 36)) for c in e)) % 97


def digits(e: str) -> str:
    return "".join(c for c in e if c in string.digits)


def kind(e: str) -> str:
    if "@" in e:
        return "email"
    if regex.fullmatch(r"[0-9]+(\.[0-9]+){3}", e):
        return "ip"
    if regex.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", e):
        return "ssn"
    if regex.match(r"[A-Z]{2}[0-9]{2}", e):
        return "iban"
    if regex.fullmatch(r"([0-9][ -]?){12,18}[0-9]", e):
        d = digits(e)
        return "card" if luhn(d) == int(d[-1]) else "digits"
    return "phone" if e[0] in "+(0123456789" else "name"


def canonical(e: str, k: str) -> str:
    if k in ("email", "name"):
        return e.lower()
    if k == "ip":
        return e
    return e.replace(" ", "") if k == "iban" else digits(e)[-10:] if k == "phone" else digits(e)


def shifted(k: str, canon: str) -> str:
    k = "card" if k == "digits" else k
    out, n = [], len(canon)
    for i, c in enumerate(canon):
        step = number(k, str(i), canon[max(0, i - s.WINDOW) : i])
        keep = {"card": i in (0, n - 1), "iban": i < 4, "name": i == n - 1 and i > 1, "email": i >= n - len(canon.split(".")[-1])}.get(k, False)
        alphabet = "23456789" if k == "phone" and i == 0 else next((a for a in s.ALPHABETS if c in a), None)
        if keep or alphabet is None or c not in alphabet:
            out.append(c)
        else:
            out.append(alphabet[(alphabet.index(c) + 1 + step % (len(alphabet) - 1)) % len(alphabet)])
    return "".join(out)


def surrogate(k: str, canon: str) -> str:
    if k == "ip":
        parts, out = canon.split("."), []
        for i, p in enumerate(map(int, parts)):
            low, n = (0, 10) if p < 10 else (10, 90) if p < 100 else (100, 156)
            out.append(str(low + (p - low + 1 + number("ip", ".".join(parts[:i])) % (n - 1)) % n))
        return ".".join(out)
    if k == "name":
        given = s._given(KEY)
        if canon in given:
            return given[canon]
        canon = shifted(k, canon)
        while canon in given:
            canon = shifted(k, canon)
        return canon
    new = shifted(k, canon)
    if k in ("card", "digits"):
        return new[:-1] + str((int(canon[-1]) - luhn(canon) + luhn(new)) % 10)
    if k == "iban":
        valid = lambda e: 98 - mod97(e[4:] + e[:2] + "00")
        return f"{new[:2]}{(int(canon[2:4]) - valid(canon) + valid(new)) % 100:02d}{new[4:]}"
    return new


def cased(e: str, new: str) -> str:
    if len(e) == len(new):
        return "".join(b.upper() if a.lower() != a else b for a, b in zip(e, new, strict=True))
    return new if e.lower() == e else new.upper() if e.upper() == e else new[:1].upper() + new[1:]


def dressed(e: str, new: str, k: str) -> str:
    if k in ("email", "ip"):
        return cased(e, new) if k == "email" else new
    left = iter(new)
    if k == "iban":
        return "".join(" " if c == " " else next(left) for c in e)
    skip, out = len(digits(e)) - len(new), []
    for c in e:
        skip -= c in string.digits
        out.append(next(left) if c in string.digits and skip < 0 else c)
    return "".join(out)


def bare(word: str) -> str:
    return regex.sub(s._ENDING, "", word)


def one_word(word: str) -> str:
    own = bare(word)
    return cased(own, surrogate("name", own.lower())) + word[len(own) :]


def plain(text: str) -> tuple[str, list[str]]:
    found = [m[0] for m in FIND.finditer(text)]
    names = {bare(w).lower() for e in found if kind(e) == "name" for w in e.split(" ")[1:]}
    kinds, out, at = [], [], 0

    def mention(m) -> str:
        if bare(m[0]).lower() in names:
            kinds.append("name")
            return one_word(m[0])
        parts = regex.split("(['’-])", m[0])
        for i, p in enumerate(parts):
            if p.lower() in names and p[0].isupper() and len(parts) > 1:
                kinds.append("name")
                parts[i] = one_word(p)
        return "".join(parts)

    for m in FIND.finditer(text):
        out.append(WORD.sub(mention, text[at : m.start()]) if names else text[at : m.start()])
        at, e, k = m.end(), m[0], kind(m[0])
        kinds.append(k)
        if k == "name":
            title, *rest = e.split(" ")
            out.append(" ".join([one_word(title) if title.lower() in names else title, *map(one_word, rest)]))
        else:
            out.append(dressed(e, surrogate(k, canonical(e, k)), k))
    out.append(WORD.sub(mention, text[at:]) if names else text[at:])
    return "".join(out), kinds


def texts() -> list[str]:
    rng = random.Random(11)
    n = lambda k: "".join(rng.choice(string.digits) for _ in range(k))
    w = lambda k: "".join(rng.choice(string.ascii_lowercase) for _ in range(k))
    out = ["Smith came. Mr. John Smith met Ann. John Smith said: JOHN, Smith's, Smithson, Smith-Jones, smith, x.smith@a.com", "a\x01b Mr. Li and Li\x01 x@y.org", "Frau Ana-Maria Li: Ana-Maria, Ana; Mme O'Brien's, O'Brien; г-н Иван Петров и Петров", ""]
    for _ in range(40):
        d, c = n(15), n(18)
        out.append(
            f"{w(5)}.{w(3).upper()}@{w(4)}-x.{w(3)}.de 10.{rng.randrange(256)}.{rng.randrange(256)}.9, ssn {n(3)}-{n(2)}-{n(4)}; +49 ({n(3)}) {n(3)} {n(4)} ({n(3)}) {n(3)}-{n(4)} {n(3)}.555.{n(4)} card {d}{luhn(d + '0')} {n(4)}-{n(4)}-{n(4)}-{n(4)} "
            f"iban DE{98 - mod97(c + 'DE00'):02d}{c} DE{n(2)} {n(4)} {n(4)} {n(4)} {n(4)} {n(2)} Mrs. {w(4).capitalize()} {w(6).capitalize()} id {n(20)}"
        )
    return out


def test_all_kinds_by_plain_code(spark):
    rows = list(enumerate(texts()))
    got = s.pseudonymize(spark.createDataFrame(rows, "doc_id int, text string"), KEY).orderBy("doc_id").collect()
    assert {k for r in got for k in r.pii} == set(s.KINDS)
    for (_, text), r in zip(rows, got, strict=True):
        assert (r.text, r.pii) == plain(text)


def test_full_spaces_stay_distinct(spark):
    """Every form of a shape is real, so all surrogates are forms of others."""
    consonants, vowels = "bcdfghjklmnpqrstvwxz", "aeiouy"
    forms = {
        "ip": [f"10.0.{i}.{j}" for i in range(10) for j in range(10)],
        "ssn": [f"{i:09d}" for i in range(300)],
        "phone": [f"2{i:02d}" for i in range(100)] + [f"1{i:02d}" for i in range(100)],
        "digits": [f"4{i:03d}000000000" for i in range(1000)],
        "name": [a + b for a in consonants for b in vowels] + [a + b + c + "a" for a in consonants for b in vowels for c in consonants],
        "iban": [f"DE{i:02d}{j:04d}00001111" for i in range(100) for j in range(3)],
        "email": [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"],
    }
    for k, canons in forms.items():
        made = s.name_surrogate("canon", KEY) if k == "name" else s.surrogate("kind", "canon", KEY)
        rows = spark.createDataFrame([(k, c) for c in canons], "kind string, canon string").withColumn("surr", F.expr(made))
        assert s.clashes(rows).isEmpty()
        got = {r.canon: r.surr for r in rows.collect()}
        assert len(set(got.values())) == len(canons) and not any(a == b for a, b in got.items()), k
        assert all(got[c] == surrogate(k, c) for c in canons[::7])
    assert set(got) == set(got.values())  # of these, every form of the shape is there


def test_a_shared_surrogate_is_an_error(spark):
    rows = spark.createDataFrame([("card", "1", "7"), ("digits", "2", "7"), ("ssn", "1", "8"), ("phone", "3", "8"), ("ssn", "1", "8")], "kind string, canon string, surr string")
    assert [tuple(r) for r in s.clashes(rows).collect()] == [("card", "7", "1", "2")]


def test_long_repeats_of_every_part(spark):
    """Patterns neither recurse nor take more than linear time; run where a task's stack is as it is."""
    n = 200_000
    parts = {"email": "x a@b" + ".c" * n, "local": "a." * n + "a@b.de", "ip": "1.2.3.4." * n, "iban": "DE89" + " A1B2" * n, "card": "4 " * n, "phone": "+49 " + "123 " * n, "name": "Mr." + " Abc" * n, "title": "Mr. " + "Ab" * n, "mention": "Mr. Abc x " + "Abc-" * n, "quotes": "Mr. Ab" + "'s" * n, "plain": "\x01" * n + "a@b.de"}
    rows = [(k, t + " y") for k, t in parts.items()]
    got = {r.k: r for r in s.pseudonymize(spark.createDataFrame(rows, "k string, text string"), KEY).collect()}
    for k, t in rows:
        if k not in ("ip", "card", "iban"):
            assert got[k].pii and got[k].text != t, k
    assert got["email"].pii == ["email"] and len(got["email"].text) == len(parts["email"]) + 2
