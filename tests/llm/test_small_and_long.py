"""Secret candidates by brute force and on long texts; mixes of many small sources."""

import random
import time

from ledgerloom.llm import mixing, secrets
from ledgerloom.llm.common import ship


def plain_candidates(text):
    good = lambda i: i < len(text) and secrets.CANDIDATE.fullmatch(text[i] * secrets.LEAST)
    found, done = [], 0
    for word in secrets.SENSITIVE.finditer(text):
        at = max(done, word.end())
        while at <= word.end() + secrets.NEAR:
            end = at
            while good(end):
                end += 1
            if end - at >= secrets.LEAST:
                found.append((at, end))
                done = at = end
            else:
                at = max(end, at + 1)
    return found


def test_candidates_against_brute_force():
    rnd = random.Random(3)
    pieces = ["token", "auth", "secret", " ", " ", ".", "A1b2C3d4", "xyz0123456789QRSTU", "-" * 9, "é", "AKIA" + "Q" * 17, "password: hunter22", "f" * 25]
    for _ in range(1500):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30)))
        assert list(secrets.candidates(text)) == plain_candidates(text), text
        base = secrets.base_spans(text)
        want = [(a, 3, b) for a, b in plain_candidates(text) if not any(s < b and a < e for s, _, e in base)
                and secrets.marginal_bytes(text, a, b) >= secrets.NOVEL * (b - a)]
        assert secrets.novel_spans(text, base) == want


def test_scan_of_long_texts_is_linear():
    secrets.scan("warm up")
    start = time.monotonic()
    assert secrets.scan("token " * 200_000) == []
    assert len(secrets.scan("password: hunter22 " * 20_000)) == 20_000
    assert secrets.scan("a" * 1_000_000 + " token " + " " * 1_000_000)[1:] == []
    assert time.monotonic() - start < 10


def test_mix_gives_small_sources_their_share(spark):
    ship(spark)
    rows = [(i, " ".join(["w"] * 20), f"host{i:03d}") for i in range(500)]
    mix = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert {round(r.target, 1) for r in mix} == {37.5, 15.0, 7.5}
    assert all(abs(r.taken - r.target) <= 1 and r.taken <= 60 for r in mix)
    assert abs(sum(r.taken for r in mix) - 10_000) <= 1


def test_mix_of_large_and_tiny_sources(spark):
    ship(spark)
    rows = [(i, " ".join(["w"] * 400), "big") for i in range(300)] + [(1000 + i, "one two three", "tiny") for i in range(3)] + [
        (2000, None, "none"), (2001, "", None), (2002, "a b", None)]
    mix = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    taken = {}
    for r in mix:
        assert r.taken <= 3 * r["size"]
        taken.setdefault((r.source, r.target), []).append(r.taken)
    assert all(abs(sum(v) - target) <= 1 for (_, target), v in taken.items())
