import math
import random
import re
from collections import Counter

import pytest

from pactframe.llm import secrets as s

from .conftest import ODD_ROWS, SMALL

KEY = "AKIA" + "Z9" * 8
HEX = "11acdfb36bb72224148e6160f674b4be45601bff"
RANDOM = "kX9vB2mQ7zL4tR8wN1cY5pD3"


def scan(text, settings=None):
    return s.Scanner(settings or s.EntropyScan()).spans(text)


def test_base_patterns_literally():
    assign = re.compile(
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    texts = [
        f'é🙂 token = "{HEX}" x', "PassWord:short", "passwd='abcdefghijkl'", "apikey==abcdefghijkl", f"{KEY} {KEY}x AKIAB",
        "ab" * 20 + "G" + "0" * 15 + " " + "0" * 16, "secret token: aaaaaaaaaaaa", f"api_key={KEY}", "token=token=abcdefghijkl",
    ]
    for text in texts:
        expected = [(*m.span(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
        expected += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        expected += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert sorted(s.base_spans(text)) == sorted(expected)
        assert set(expected) <= set(scan(text))


def test_entropy_by_counts_equals_entropy_from_scratch():
    for text in (RANDOM * 3, HEX, "aaaaaaaaaaaaaaaaaaaaaaaaaaa1b2c3d4e5f6", "abcdefghijklmnopqrstuvwxyz0123456789" * 2):
        for bits in (2.5, 3.0, 3.75, 4.2):
            covered = set()
            for at in range(len(text) - 19):
                part = text[at : at + 20]
                entropy = -sum(n / 20 * math.log2(n / 20) for n in Counter(part).values())
                mixed = any(c.isdigit() for c in part) and any(c.isalpha() for c in part)
                if entropy >= bits - 1e-9 and mixed:
                    covered |= set(range(at, at + 20))
            got = set()
            for start, end in s.high_windows(text, 20, bits, True):
                assert not got & set(range(start, end))
                got |= set(range(start, end))
            assert got == covered


def test_random_strings_are_found_and_words_are_not():
    assert scan(f"see {RANDOM} here") == [(4, 28, "entropy_base64")]
    assert scan(f"see {HEX.upper()} here") == [(4, 44, "entropy_hex")]
    assert scan("erberbeeinheitkeiterandmanyotherletters") == []


def test_allowed_strings_are_suppressed_but_base_ones_stay():
    assert scan("id 123e4567-e89b-12d3-a456-426614174000 end") == []
    assert scan("EXAMPLE" + RANDOM) == []
    text = "token=EXAMPLE" + RANDOM
    assert [k for *_, k in scan(text)] == ["assign"]
    assert scan(RANDOM, s.EntropyScan(allowed=(RANDOM,))) == []


def test_odd_rows_and_offsets(docs):
    rows = [*ODD_ROWS, (30, f"é🙂 token = {HEX}"), (31, "x" * 100_000 + KEY)]
    found = s.secret_spans(docs(rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["id"]: [tuple(x) for x in r["spans"]] for r in found}
    assert by_id[30] == [(3, 51, "assign"), (11, 51, "hex")]
    assert by_id[31] == [(100_000, 100_020, "access")]
    assert all(not by_id[i] for i in (1, 2, 3, 4, 8))
    assert s.secret_spans(docs([])).collect() == []


@pytest.mark.parametrize(
    ("text", "expected"),
    [(f"{KEY} a", "[SECRET] a"), (f"a token={HEX} b {KEY}", "a [SECRET] b [SECRET]"), ("", ""), ("plain", "plain"), (HEX, "[SECRET]")],
)
def test_masking(text, expected):
    assert s.redacted(text, scan(text), "[SECRET]") == expected


def test_masked_table_keeps_rows_and_columns(docs):
    rows = [*ODD_ROWS, (30, f"token = {HEX}!")]
    frame = docs(rows)
    masked = s.redact_secrets(frame)
    assert masked.schema == frame.schema
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert masked.count() == len(rows) and texts[30] == "[SECRET]!" and texts[1] is None


def test_query_against_plain_search(session):
    import hashlib

    from pactframe.llm.queries import op7_secrets

    texts = {r["doc_id"]: r["text"] for r in session.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rank = {k: n for n, k in enumerate(("assign", "access", "hex"))}
    for row in op7_secrets(session, SMALL).collect():
        base = sorted(s.base_spans(texts[row["doc_id"]]), key=lambda x: (x[0], rank[x[2]]))
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(x[2] == k for x in base) for k in rank]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_a_candidate_is_reported_and_masked_whole():
    for secret in ("kXbvBamQszLptRowNicYqpDe" + RANDOM, "x" * 20 + RANDOM, RANDOM + "y" * 20):
        text = f"see {secret} here"
        assert scan(text) == [(4, 4 + len(secret), "entropy_base64")]
        assert s.redacted(text, scan(text), "[SECRET]") == "see [SECRET] here"


def test_letters_of_both_cases_need_no_digit():
    assert scan("see kXbvBamQszLptRowNicYqpDe here") == [(4, 28, "entropy_base64")]
    assert scan("see kxbvbamqszlptrownicyqpde here") == []


def test_time_grows_with_the_text(session):
    """Thousands of candidates in one text, as in a list of checksums."""
    import time

    def seconds(lines):
        text = "\n".join(f"{k:05d}Qx{'ab9Z' * 4}{k * 7919 % 99991:05d}kLm{k % 13}Vw {k:08x}{'9f' * 12} name{k}" for k in range(lines))
        began = time.perf_counter()
        assert len(scan(text)) >= lines
        return time.perf_counter() - began

    few, many = seconds(4000), seconds(16_000)
    assert many < 8 * few and many < 6


def test_covered_candidates_against_plain_comparison():
    source = random.Random(7)
    parts = [KEY, HEX, RANDOM, f"token={HEX}", f"password: {RANDOM}", "plain words", HEX.upper() + RANDOM, "x" * 30, f"api_key='{HEX[:20]}'"]
    for _ in range(200):
        text = source.choice(["", " "]).join(source.choice(parts) for _ in range(source.randrange(1, 9)))
        scanner, found = s.Scanner(s.EntropyScan()), s.base_spans(text)
        for kind, pattern in scanner.patterns:
            for match in pattern.finditer(text):
                start, end = match.span()
                covered = any(a <= start and end <= b for a, b, _ in found)
                allowed = scanner.allowed.fullmatch(match.group())
                if not covered and not allowed and any(s.high_windows(match.group(), 20, kind.bits, kind.mixed, kind.cased)):
                    found.append((start, end, kind.kind))
        assert sorted(scanner.spans(text)) == sorted(found)
