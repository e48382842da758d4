"""Secret scans against the patterns applied one by one."""

import hashlib
import importlib
import math
import random
import re

import plain
import pytest
from perigee.llm import secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def shown(spans):
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans]


def check(docs):
    found = secrets.report(docs).collect()
    assert len(found) == docs.count()
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    want = set()
    for doc_id, text in texts:
        spans = base(text)
        digest = hashlib.sha256(",".join(shown(spans)).encode()).hexdigest()
        want.add((doc_id, *[sum(k == kind for _, k, _ in spans) for kind in (0, 1, 2)], digest))
    assert {(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found} == want
    by_digest = {hashlib.sha256(",".join(shown(base(t))).encode()).hexdigest(): shown(base(t)) for _, t in texts}
    for r in found:
        own = r["spans"].split(",") if r["spans"] else []
        assert set(by_digest[r["base_sha256"]]) <= set(own)
        assert all(s.startswith("markov:") for s in set(own) - set(by_digest[r["base_sha256"]]))


def test_tables(spark):
    check(spark.read.parquet(f"{plain.SF}/documents.parquet"))


def test_awkward_rows(spark):
    check(plain.awkward(spark, "spans n_hex"))
    kept = secrets.scanned(plain.awkward(spark, "spans other"), secrets.fit(plain.awkward(spark)))
    assert kept.filter("other = 'own'").count() == len(plain.AWKWARD) and kept.schema["spans"].dataType.simpleString() == "array<string>"


def test_empty(spark):
    assert secrets.report(plain.empty(spark)).collect() == []


def test_overlaps_agree_with_all_pairs():
    draw = random.Random(3)
    for _ in range(200):
        spans = sorted((a := draw.randrange(60), draw.randrange(3), a + draw.randrange(1, 9)) for _ in range(draw.randrange(12)))
        taken = secrets.Taken(spans)
        for start in range(62):
            end = start + draw.randrange(1, 6)
            assert taken.overlaps(start, end) == any(a < end and start < b for a, _, b in spans)


def test_random_strings_are_told_from_names(spark):
    draw = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    names = ["readConfigurationFile2", "user_session_manager_v2", "getElementsByClassName", "Donaudampfschifffahrt2020"]
    rows = [(i, " ".join(draw.choices(names, k=30)) + " the configuration of a session manager reads element names", "en", "a", 1) for i in range(60)]
    ratios = secrets.fit(spark.createDataFrame(rows, plain.SCHEMA))
    drawn = ["".join(draw.choices(letters, k=32)) for _ in range(40)]
    hits = sum(bool(secrets.markov_spans(f"see {s} there", ratios, [])) for s in drawn)
    assert hits >= 36
    assert not any(secrets.markov_spans(f"see {s} there", ratios, []) for s in names)


def test_random_strings_of_every_alphabet_are_found(spark):
    draw, lower, digits = random.Random(11), "abcdefghijklmnopqrstuvwxyz", "0123456789"
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet")
    ratios = secrets.fit(docs)
    kinds = {
        "lower": ("", lower, 32), "upper": ("", lower.upper(), 32), "hex": ("", digits + "abcdef", 20), "upper hex": ("", digits + "ABCDEF", 32),
        "prefixed": ("sk_live_", lower + lower.upper() + digits, 24),
    }
    found = {}
    for kind, (prefix, letters, size) in kinds.items():
        drawn = [prefix + "".join(draw.choices(letters, k=size)) for _ in range(100)]
        found[kind] = sum(bool(secrets.markov_spans(f"see {s} there", ratios, [])) for s in drawn)
    assert min(found.values()) >= 98, found
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    assert not any(secrets.markov_spans(t, ratios, secrets.base_spans(t)) for t in texts)


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


HELD_OUT = (
    "socket ssl errno signal http.client urllib.request xml.dom.minidom logging unittest.mock asyncio collections json email.message "
    "multiprocessing pathlib subprocess threading typing inspect ast dis locale ctypes")


def held_out_identifiers():
    """Names of modules that gave no sample."""
    seen, found = set(secrets.sample_identifiers()), set()
    for module in HELD_OUT.split():
        own = importlib.import_module(module)
        for name in dir(own):
            found.add(name)
            if isinstance(value := getattr(own, name, None), type):
                found.update(dir(value))
    return sorted(n for n in found - seen if len(n) >= secrets.LEAST_RUN)


def test_held_out_identifiers_are_ordinary(ratios):
    names = held_out_identifiers()
    wrong = [n for n in names if secrets.markov_spans(n, ratios, [])]
    print("identifiers", len(names), "marked", len(wrong))
    assert len(names) >= 500 and len(wrong) <= 0.01 * len(names), wrong
    clean = [
        "getElementsByClassName", "readConfigurationFile2", "user_session_manager_v2", "MAX_CONNECTION_RETRY_COUNT", "/usr/local/share/applications",
        "AbstractSingletonProxyFactoryBean", "2024-01-01T00-00-00", "=" * 60, "-" * 60, "_" * 30, "application/json", "2024-12-31", "20240131235959"]
    assert [n for n in clean if secrets.markov_spans(f"see {n} there", ratios, [])] == []


def test_short_random_strings_are_found(ratios):
    draw, letters = random.Random(8), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for size in (12, 13, 15, 20):
        drawn = ["".join(draw.choices(letters, k=size)) for _ in range(200)]
        found = sum(bool(secrets.markov_spans(f"see {s} there", ratios, [])) for s in drawn)
        print(size, found)
        assert found >= 190
    uuids = [f"{draw.getrandbits(32):08x}-{draw.getrandbits(16):04x}-{draw.getrandbits(16):04x}-{draw.getrandbits(16):04x}-{draw.getrandbits(48):012x}" for _ in range(100)]
    assert sum(bool(secrets.markov_spans(u, ratios, [])) for u in uuids) >= 98


def test_parts_beside_a_base_span_are_scored(ratios):
    draw, letters = random.Random(9), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    hits = 0
    for _ in range(100):
        left, hexa, right = "".join(draw.choices(letters, k=30)) + "Z", "".join(draw.choices("0123456789abcdef", k=24)), "Z" + "".join(draw.choices(letters, k=30))
        text = f"é {left}{hexa}{right} end"
        base = secrets.base_spans(text)
        assert len(base) == 1
        found = secrets.markov_spans(text, ratios, base)
        assert all(e <= base[0][0] or s >= base[0][2] for s, _, e in found)
        hits += len(found) == 2
    assert hits >= 95


def plain_spans(text, ratios, base):
    """The scan in plain form: run by run, character by character."""
    kept = "".join(" " if any(a <= i < e for a, _, e in base) else c for i, c in enumerate(text))
    found = []
    for m in re.finditer("[A-Za-z0-9+/_=-]{8,}", kept):
        before, total = secrets.STATES, 0.0
        for c in m[0]:
            total += ratios[before, secrets.ALPHABET.index(c)]
            before = secrets.ALPHABET.index(c)
        if total > math.log(secrets.PRIOR_ODDS):
            found.append((m.start(), 3, m.end()))
    return found


def test_spans_equal_the_plain_scan(spark, ratios):
    draw, letters = random.Random(10), "AZaz09+/_=-éβ日🙂 \n.:"
    texts = [r["text"] or "" for r in spark.read.parquet(f"{plain.SF}/documents.parquet").collect()]
    texts += ["".join(draw.choices(letters, k=draw.randrange(120))) for _ in range(200)] + ["", "x" * 10, "é" * 9 + "Zq8Xv2Kp0Lw5" * 3]
    assert any(plain_spans(t, ratios, secrets.base_spans(t)) for t in texts)
    for text in texts:
        base = secrets.base_spans(text)
        assert secrets.markov_spans(text, ratios, base) == plain_spans(text, ratios, base)
