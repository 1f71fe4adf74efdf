import hashlib
import re
import time

import pytest

from likertlake.llm import pii, queries


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    """The base spans, straight from the rules."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (rule, ok) in enumerate(rules) for m in re.finditer(rule, text or "") if ok(m.group()))


def slowly(text):
    """All spans: every character carries the source characters that it came from."""
    chars = [(c, i, i + 1) for i, c in enumerate(text)]
    for step in pii.TRANSDUCERS:
        now = "".join(c for c, _, _ in chars)
        for start, end, new in reversed(step(now)):
            chars[start:end] = [(c, chars[start][1], chars[end - 1][2]) for c in new]
    plain = "".join(c for c, _, _ in chars)
    found = {(s, k, e) for s, k, e in brute(text)}
    more = {(chars[s][1], k, chars[e - 1][2]) for s, k, e in brute(plain) if plain[s:e] != text[chars[s][1] : chars[e - 1][2]]}
    return sorted([(*x, False) for x in found] + [(*x, True) for x in more - found])


PLAIN = [
    "a@b.c@d.e x@y @z.w@q.r.s a.b@c-d.e-f. a@b.c_d@e.f ..@.. é@x.de %+@1.2", "1.2.3.4.5 999.1.1.1 001.002.003.256 1.2.3.4.5.6.7.8 0.0.0.0",
    "4111 1111-1111 1111 4111111111111111x 4111  1111 1111 1111 00000000000000000000 0000-0000-0000 5", "+1 (974) 555-3436 +1234567 8 +12.34.56.78.9) ++491701234567 +1\t234567890",
    "+4111111111111111 4111111111111111+49 30 1234567", "", "@", "+", "no data at all, only point and dot.",
]

DISGUISED = [
    ("email", "john.doe (at) example (dot) com"), ("email", "john [AT] mail[.]example[.]org"), ("email", "jane at example dot com"), ("email", "jane dot roe at mail dot example dot org"),
    ("email", "jоhn@exаmple.com"), ("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"), ("email", "𝐣𝐨𝐡𝐧@𝐱.𝐝𝐞"), ("email", "jo​hn@exam­ple.com"), ("email", "ana arroba correo punto com"),
    ("ip", "192[.]168[.]1[.]20"), ("ip", "192 dot 168 dot 1 dot 20"), ("ip", "one nine two dot one six eight dot one dot two"), ("ip", "１０．０．０．１"), ("ip", "l92.168.O.1"),
    ("card", "four one one one one one one one one one one one one one one one"), ("card", "4111 1111 1111 1111"), ("card", "4111–1111–1111–1111"), ("card", "4lll 1111 1111 1111"),
    ("phone", "+1 four one five 555 0199"), ("phone", "plus four nine three zero one two three four five six"), ("phone", "+٤٩ ٣٠ ١٢٣٤٥٦٧"), ("phone", "+33 1 23 45 67 89"),
]

CLEAN = [
    "We met at noon, dot by dot, at one point two of three were there.", "un deux trois quatre, cinq six sept", "Look at this dot on the map (at last).", "3 plus 4 is 7; Привет, как дела? Ελληνικά",
    "Version 1.2.3 of 2024-01-02 costs 1 500 or so – see page 12", "if a < b and (a[i].x > c[.5]) then", "room 101O at 10 point 5", "zero one", "ſix ſix ſEVEN İ", "",
]


def test_base_spans(texts):
    for t in [*PLAIN, *CLEAN, *texts.values(), *[d for _, d in DISGUISED]]:
        assert pii.base_spans(t) == brute(t)


@pytest.mark.parametrize("kind, text", DISGUISED)
def test_a_disguise_is_found_with_its_source_characters(kind, text):
    for before, after in (("", ""), ("Write to: ", " or not."), ("é𝒳 — 𝐚 [.] １\n", "\nEnd")):
        found = [(pii.KINDS[k], s, e) for s, k, e, disguised in pii.spans(before + text + after) if disguised]
        assert (kind, len(before), len(before) + len(text)) in found


@pytest.mark.parametrize("text", CLEAN)
def test_prose_has_none(text):
    assert pii.spans(text) == []


def test_way_back_against_one_character_at_a_time(texts):
    joined = " und ".join(d for _, d in DISGUISED)
    for t in [joined, *PLAIN, *CLEAN, *[d + p for _, d in DISGUISED for p in PLAIN], *list(texts.values())[::7]]:
        assert pii.spans(t) == slowly(t)


def test_deletions_and_replacements_map_back():
    r = pii.Rewritten("abcdefgh", [(0, 1, ""), (2, 4, "X"), (4, 5, ""), (6, 7, "YZ")])
    assert r.text == "bXfYZh"
    assert [r.back(i, i + 1) for i in range(6)] == [(1, 2), (2, 4), (5, 6), (6, 7), (6, 7), (7, 8)]
    assert r.back(0, 6) == (1, 8) and r.back(1, 2) == (2, 4)


def test_query_against_brute_force(spark, sf_dir, texts):
    rows = queries.op13_personal_data(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple([k for _, k, _ in want].count(n) for n in range(4))
        listed = lambda spans: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert r.spans == listed([x[:3] for x in slowly(texts[r.doc_id])])


def test_long_texts_take_time_in_proportion():
    for unit in ("a", "1", "1.", "+1 ", "a@", "@a.b", "one ", " dot ", "l", "(at)", "​", "a dot ", "a at b dot "):
        start = time.perf_counter()
        pii.spans(unit * (600_000 // len(unit)))
        assert time.perf_counter() - start < 20


def test_odd_rows(odd, none):
    got = pii.scan(odd.withColumnRenamed("kept", "pii"))
    assert got.count() == odd.count() and got.columns.count("pii") == 1
    assert all(r.pii == [] for r in got.where("text is null or text = ''").collect())
    assert pii.scan(none).collect() == []


def test_redaction(spark):
    df = pii.scan(spark.createDataFrame([(1, "to jane at example dot com, +1 (974) 555-3436!"), (2, None), (3, "none")], "doc_id int, text string"))
    got = {r.doc_id: r.x for r in df.select("doc_id", pii.redacted(df).alias("x")).collect()}
    assert got == {1: "to <email>, <phone>!", 2: None, 3: "none"}
