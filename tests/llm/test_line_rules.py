from __future__ import annotations

from collections import Counter

import pytest
import regex

from footfall.llm import line_rules
from footfall.llm.queries import op6_quality_rules
from tests.llm.frames import awkward, blank_words, documents, noise


def brute(text):
    found = blank_words(text)
    n = len(found)
    windows = Counter(tuple(found[i : i + 8]) for i in range(n - 7))
    covered = set()
    for i in range(n - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in (text or "").split("\n") if blank_words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_counts_equal_plain_counting(spark, sf_dir):
    extra = noise("ab \n\t#|\x0b\x1c é", 1500, 200)
    made = spark.createDataFrame(list(enumerate(extra)), "doc_id long, text string")
    every = made.unionByName(documents(spark, sf_dir).select("doc_id", "text"))
    for row in line_rules.word_counts(every).collect():
        assert counts(row) == brute(row.text)


def test_awkward_rows(spark):
    rows = line_rules.word_counts(awkward(spark)).collect()
    assert len(rows) == 11
    assert all(counts(r) == brute(r.text) for r in rows)
    assert line_rules.judge(awkward(spark)).count() == 11
    assert line_rules.judge(awkward(spark, [])).count() == 0


@pytest.mark.parametrize(
    "line, fails",
    [
        ("A plain line of words.", False),
        ("Home | About | Contact", True),
        ("win*** money$$$ now### here", True),
        ("BUY THIS NOW", True),
        ("Buy! this! now!", True),
        ("go go go go go home", True),
        ("Licensed under the Apache License, Version 2.0.", True),
        ("NASA and ESA went up.", False),
        ("||", False),
        ("Home About Contact", True),
        ("Accueil - Produits - Panier", True),
        ("Home, about, contact.", False),
        ("The home page has news and search for products", False),
        ("Alle Rechte vorbehalten 2024", True),
        ("", False),
    ],
)
def test_lines(spark, line, fails):
    frame = spark.createDataFrame([(1, line)], "doc_id long, text string")
    row = line_rules.clean_lines(frame).first()
    assert (row.n_failed_lines == 1) is fails
    assert row.cleaned_text == ("" if fails else line)


def test_documents_are_rejected_by_what_they_lose(spark):
    good = "one line of plain prose that goes on for a while"
    cases = {f"{good}\nA | B | C": True, f"{good[:10]}\n{'X | ' * 20}": False, "": True}
    frame = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    kept = {r.text: r.rules_kept for r in line_rules.clean_lines(frame).collect()}
    assert kept == cases


def plain_fails(line):
    """The line rules once more, in plain Python."""
    said = line.lower()
    if any(phrase in said for phrase in line_rules.BOILERPLATE):
        return True
    found = blank_words(line)
    n = len(found)
    letters = regex.findall(r"\p{L}+", line)
    menu = [w for w in letters if w.lower() in line_rules.NAVIGATION]
    ended = line.rstrip(" \t\r").rstrip(")]}\u00bb\u201d\u2019\"'")[-1:] in tuple(".!?…:;")
    if len(letters) >= 3 and 3 * len(menu) > 2 * len(letters) and not ended:
        return True
    if n < 3:
        return False
    stuttered, tokens = 0, line.split(" ")
    tokens = [t for t in tokens if t]
    for same in _runs(tokens):
        if len(same) >= 3:
            stuttered += sum(map(len, same)) + len(same) - 1
    return (
        sum(c in "#*$%&<>" for c in line) > 0.5 * n
        or sum(c in "|»›•" for c in line) > 0.2 * n
        or line.count("!") > 0.5 * n
        or (line == line.upper() and regex.search(r"\p{Lu}{2}", line) is not None)
        or stuttered > 0.4 * len(line)
    )


def _runs(tokens):
    out = []
    for t in tokens:
        if out and out[-1][0] == t:
            out[-1].append(t)
        else:
            out.append([t])
    return out


def test_cleaned_texts_equal_plain_rules(spark, sf_dir):
    docs = documents(spark, sf_dir)
    extra = noise("Hh oO!|\n#.", 500, 120) + ["Home | News\nSome text.", "next home\nprevious help menu"]
    every = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(-i - 1, x) for i, x in enumerate(extra)], "doc_id long, text string")
    )
    removed = 0
    for row in line_rules.clean_lines(every).collect():
        lines = (row.text or "").split("\n")
        fails = [plain_fails(line) for line in lines]
        assert row.n_failed_lines == sum(fails), row.doc_id
        assert row.cleaned_text == "\n".join(x for x, f in zip(lines, fails) if not f)
        lost = sum(len(x) for x, f in zip(lines, fails) if f)
        share = lost / max(1, sum(map(len, lines)))
        assert abs(row.lost_share - share) < 1e-12 and row.rules_kept == (share <= 0.5)
        removed += sum(fails)
    assert removed > 50


def test_keep_clean_passes_cleaned_texts_on(spark, sf_dir):
    docs = documents(spark, sf_dir)
    kept = line_rules.keep_clean(docs)
    assert kept.schema == docs.schema or kept.columns == docs.columns
    judged = line_rules.judge(docs).where("kept").collect()
    cleaned = {r.doc_id: r.cleaned_text for r in judged}
    before = {r.doc_id: r for r in docs.collect()}
    rows = kept.collect()
    assert {r.doc_id: r.text for r in rows} == cleaned
    assert any(r.text != before[r.doc_id].text for r in rows)
    for r in rows:
        assert r.n_chars == before[r.doc_id].n_chars and r.source == before[r.doc_id].source
        assert not any(map(plain_fails, r.text.split("\n")))


def test_keep_clean_with_awkward_columns(spark):
    from pyspark.sql import functions as F

    frame = awkward(spark).select("*", F.lit(5).alias("a.b"), F.lit(6).alias("n_words"))
    kept = line_rules.keep_clean(frame)
    assert kept.columns == frame.columns
    assert {(r["a.b"], r["n_words"]) for r in kept.collect()} <= {(5, 6)}
    words = " ".join(f"word{i}" for i in range(30)) + "."
    text = f"{words}\nHome | About | Contact"
    only = spark.createDataFrame([(text,), (None,), (text,)], "text string")
    assert [r.text for r in line_rules.keep_clean(only).collect()] == [words] * 2


def test_query_keeps_good_documents(spark, sf_dir):
    labels = documents(spark, sf_dir, "labels")
    rows = op6_quality_rules(spark, sf_dir).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)
    plan = op6_quality_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
