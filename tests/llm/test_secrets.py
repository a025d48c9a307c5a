from __future__ import annotations

import hashlib
import re

import numpy as np

from footfall.llm import secrets
from footfall.llm.queries import op8_secrets
from tests.llm.frames import awkward, documents, noise

PATTERNS = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                re.I | re.A), lambda m: len(m[2]) >= 6),
    (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def brute(text):
    return sorted(
        (m.start(), kind, m.end())
        for kind, (pattern, good) in enumerate(PATTERNS)
        for m in pattern.finditer(text or "")
        if good(m)
    )


def base(spans):
    return [(s.start, s.kind, s.stop) for s in spans if s.kind < 3]


def test_base_candidates_equal_plain_matching():
    letters = ["token", "ToKen", "api_key", "apikey", "=", ": ", '"', "AKIA", "Z9", "a", "f0", "é", " "]
    for text in noise(letters, 4000, 25) + ["passwd: ſecret", "toKen = abc", "AKIA" + "A" * 16]:
        assert [c for c in secrets.candidates(text) if c[1] < 3] == brute(text), text


def test_awkward_rows(spark):
    frame = awkward(spark)
    texts = sorted(r.text or "" for r in frame.collect())
    rows = secrets.scan(frame).collect()
    assert sorted(map(str, (base(r.spans) for r in rows))) == sorted(str(brute(t)) for t in texts)
    assert secrets.scan(awkward(spark, [])).count() == 0
    kept = secrets.keep_safe(frame)
    assert kept.columns == frame.columns and kept.count() == 11


def test_network_finds_secrets_without_telling_words():
    rng = np.random.default_rng(3)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(400)]
    plain = ["".join(rng.choice(["the", "ing", "on", "er", "st"], 9)) for _ in range(400)]
    windows = [secrets.windows(f"say {x} so", 4, 4 + len(x)) for x in hexes + plain]
    labels = np.repeat([1.0, 0.0], 400)
    train = np.arange(800) % 4 > 0
    network = secrets.fit([w for w, t in zip(windows, train) if t], labels[train])
    held = [w for w, t in zip(windows, train) if not t]
    coded = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1).astype(int)
    flagged = network.probability(coded) >= network.threshold
    assert flagged[labels[~train] == 1].mean() > 0.95
    assert flagged[labels[~train] == 0].mean() < 0.05


def test_redaction(spark):
    frame = awkward(spark, [(1, 'a token = "abcdef12" b'), (2, None), (3, "plain")])
    rows = secrets.keep_safe(frame).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ['a <assign>" b', None, "plain"]


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    rows = op8_secrets(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        named = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == i for _, k, _ in spans) for i in range(3)
        )


def test_all_places_of_a_long_candidate_are_read():
    for length in (16, 40, 41, 60, 61, 200):
        plain = "w" * length
        same = secrets.windows(f"say {plain} so", 4, 4 + length)
        assert len(same) % secrets.LENGTH == 0
        for at in range(length):
            other = plain[:at] + "7" + plain[at + 1 :]
            assert secrets.windows(f"say {other} so", 4, 4 + length) != same


def test_secrets_in_the_middle_of_long_tokens_are_found():
    rng = np.random.default_rng(4)

    def text(n):
        return "".join(rng.choice(["the", "ing", "on", "er", "st"], n))

    def secret(n=40):
        return "".join(rng.choice(list("0123456789abcdef"), n))

    bad = [f"say {secret()} so" for _ in range(400)]
    good = [f"say {text(9)} so" for _ in range(400)]
    seen = [secrets.windows(t, 4, len(t) - 3) for t in bad + good]
    network = secrets.fit([w[: secrets.LENGTH] for w in seen], np.repeat([1.0, 0.0], 400))

    def flagged(token):
        coded = np.frombuffer(secrets.windows(f"say {token} so", 4, 4 + len(token)), np.uint8)
        scores = network.probability(coded.reshape(-1, secrets.LENGTH).astype(int))
        return scores.max() >= network.threshold

    assert np.mean([flagged(text(20) + secret(120) + text(20)) for _ in range(50)]) > 0.9
    assert np.mean([flagged(text(60)) for _ in range(50)]) < 0.1


def _texts(n):
    rng = np.random.default_rng(6)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(n)]
    plain = ["".join(rng.choice(["the", "ing", "on", "er", "st"], 9)) for _ in range(n)]
    return [(i, f"say {x} so") for i, x in enumerate(hexes + plain)]


def test_training_sees_all_candidates_in_parts(spark, tmp_path):
    docs = awkward(spark, _texts(500))
    secrets.propose(docs, f"{tmp_path}/c")
    parted, parts, n = secrets._stored_parts(spark, f"{tmp_path}/c", 150)
    rows = spark.read.parquet(parted).collect()
    want = {(secrets.windows(t, a, b), k < 3) for _, t in _texts(500)
            for a, k, b in secrets.candidates(t)}
    want = {(w[i : i + secrets.LENGTH], y) for w, y in want for i in range(0, len(w), secrets.LENGTH)}
    got = [
        (bytes(windows[i : i + secrets.LENGTH]), bool(labels[i // secrets.LENGTH]))
        for r in rows
        for windows, labels in ((r.windows, r.secret), (r.held_windows, r.held_secret))
        for i in range(0, len(windows), secrets.LENGTH)
    ]
    assert parts > 4 and len(rows) == parts and n == len(got) == len(want) and set(got) == want
    assert 0.15 < sum(len(r.held_secret) for r in rows) / n < 0.35


def test_network_of_many_parts_is_one_network(spark, tmp_path):
    secrets.propose(awkward(spark, _texts(500)), f"{tmp_path}/c")
    network = secrets.train(spark, f"{tmp_path}/c", 150)
    again = secrets.train(spark, f"{tmp_path}/c", 150)
    assert network.threshold == again.threshold < 1 and (network.kernel == again.kernel).all()
    rng = np.random.default_rng(7)
    fresh = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(200)]
    words = ["".join(rng.choice(["the", "ing", "on", "er", "st"], 9)) for _ in range(200)]

    def flagged(x):
        coded = secrets._coded(b"".join(secrets.windows(f"say {t} so", 4, 4 + len(t))[: secrets.LENGTH] for t in x))
        return (network.probability(coded) >= network.threshold).mean()

    assert flagged(fresh) > 0.9 and flagged(words) < 0.1
