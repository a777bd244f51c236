"""Decontamination, quality rules, mixing, license scans."""

from collections import Counter, defaultdict

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm import decontaminate, license_scan, mixing, quality_rules
from lakeops.llm.queries import QUERIES
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def items(llm, *rows):
    return llm.createDataFrame(list(rows), "item_id bigint, text string")


def answer(found):
    rows = found.select(
        "id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items"), 256), "contaminated", "copies"
    ).collect()
    return sorted([tuple(r[:6]) for r in rows for _ in range(r[6])], key=repr)


def test_contamination_edge_cases(llm, docs):
    words = [f"Word{i}" for i in range(40)]
    bench = [(1, " ".join(words)), (2, "short ITEM here"), (3, None), (4, "..!"), (None, "no id item"), (5, "short item here"), (1, " ".join(words))]
    rows = [
        (1, None), (2, ""), (3, "--- !!"), (4, "A short-item, HERE and more"), (5, " ".join(words[3:20]).upper()),
        (6, LONG + " " + " ".join(words)), (7, "x " * 300 + " ".join(words[:13])), (8, "no id item"), (None, "short item here"),
        (4, "A short-item, HERE and more"), (4, "other text of the same id"), (9, " ".join(words[:12])), (10, "É word0 é " + " ".join(words)),
        (11, "short item here " * 50),
    ]
    got = answer(decontaminate.contamination(docs(*rows), items(llm, *bench)))
    assert got == sorted(brute.contamination(rows, bench), key=repr)


def test_contamination_shuffled_set(llm, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    rows = [(1, "one two three"), (2, "one two"), (3, "zero one two three four")]
    got = answer(decontaminate.contamination(docs(*rows), items(llm, (1, "one two three"))))
    assert got == sorted(brute.contamination(rows, [(1, "one two three")]), key=repr)


def test_contamination_shuffled_long_text(llm, docs, monkeypatch):
    """Beyond the bound in bytes; the join's rows carry no arrays of words."""
    long = " ".join(f"w{i % 7000}" for i in range(20_000))
    bench = items(llm, (1, " ".join(f"w{i}" for i in range(100, 130))), (2, "w5 w6 w7"), (3, "not there at all"))
    df = docs((1, long), (2, "x " + long), (1, long), (None, "w5 w6 w7"), (4, None))
    want = answer(decontaminate.contamination(df, bench))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    found = decontaminate.contamination(df, bench)
    assert answer(found) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    exploded = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert not re.search(r"[\[ ]words#", plan[exploded] + plan[exploded + 1])


def test_contamination_of_columns_with_dots(llm, docs):
    df = docs((1, "one two three"), (2, "four")).withColumnRenamed("text", "my.text")
    bench = items(llm, (1, "one two")).withColumnRenamed("text", "its.text")
    found = decontaminate.contamination(df, bench, text="my.text", item_text="its.text").collect()
    assert {r["id"]: r["items"] for r in found} == {1: ["1"], 2: []}


def test_contamination_empty(llm, docs):
    assert decontaminate.contamination(docs(), items(llm, (1, "a b"))).count() == 0
    rows = [(1, "a b"), (2, None)]
    assert answer(decontaminate.contamination(docs(*rows), items(llm))) == sorted(brute.contamination(rows, []), key=repr)


def test_removal(llm, docs):
    bench = items(llm, (1, "this is the secret test item of ours and nobody knows it yet today"))
    text = "This is the secret test item of ours, and nobody knows it yet today"
    df = docs((1, f"before {text} after!"), (2, "clean"), (None, None), (3, text), (3, text))
    left = decontaminate.remove_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted([tuple(r) for r in left.select("doc_id", "text").collect()], key=repr) == [(2, "clean"), (None, None)]
    cut = decontaminate.remove_spans(df, bench, mask="_").where("doc_id = 1").first()["text"]
    assert cut == "before _ _ _ _ _ _ _ _, _ _ _ _ _ _ after!"
    assert decontaminate.remove_spans(df, bench).count() == 5


def test_quality_measures(llm, docs):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c"), (5, "a a a a"), (6, "x\nx\n \nx y\nX"), (7, LONG),
        (8, "#a *b $ % & | < > \x0b c\x0cd\re"), (9, "a b c d " * 30), (10, "é à ü " + "w " * 60), (None, "a b"), (10, "a b"),
    ]
    judged = quality_rules.judge(docs(*rows))
    got = judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(d, *brute.quality(t)) for d, t in rows], key=repr)
    assert quality_rules.judge(docs()).count() == 0


def test_hosts(docs):
    good = " ".join(f"word{i}" for i in range(60))
    odd = good + " #" * 20
    rows = [(i, good, "fine") for i in range(20)] + [(20, odd, "fine")]
    rows += [(100 + i, odd, "bad") for i in range(14)] + [(120 + i, good, "bad") for i in range(6)]
    rows += [(200 + i, "junk", None) for i in range(60)] + [(300, good, None)]
    kept = {r["doc_id"] for r in quality_rules.keep_good(docs(*rows)).collect()}
    # a fine rule counts on a bad host only; a host of junk is blocked
    assert kept == {*range(21), *range(120, 126)}


def sums(hosts):
    """The sums that the prior is made from, of (failed, docs) pairs."""
    return len(hosts), float(sum(f for f, _ in hosts)), float(sum(n for _, n in hosts)), sum(f * f / n for f, n in hosts), float(sum(n * n for _, n in hosts))


def test_prior():
    assert quality_rules.beta_prior(0, None, None, None, None) == (0.5, 0.5)
    a, b = quality_rules.beta_prior(*sums([(1, 4)] * 3))
    assert a / (a + b) == pytest.approx(0.25) and a + b == quality_rules.STRONGEST
    for alike in ([(0, 5), (0, 1)], [(5, 5), (1, 1)], [(1, 1), (0, 1), (1, 1)], [(3, 7)]):
        a, b = quality_rules.beta_prior(*sums(alike))
        assert a + b == pytest.approx(quality_rules.STRONGEST)


def test_prior_of_simulated_hosts():
    """Chance in hosts of few documents is no spread; a true spread is found again."""
    rng = random.Random(3)
    draw = lambda p, n: (sum(rng.random() < p for _ in range(n)), n)
    hosts = [draw(0.2, rng.choice([1, 2, 3, 40])) for _ in range(20_000)]
    a, b = quality_rules.beta_prior(*sums(hosts))
    rates = [(f + a) / (n + a + b) for f, n in hosts if n <= 3]
    assert a / (a + b) == pytest.approx(0.2, abs=0.02) and max(rates) < 0.5
    hosts = [draw(rng.betavariate(2, 6), rng.choice([1, 2, 3, 40])) for _ in range(20_000)]
    a, b = quality_rules.beta_prior(*sums(hosts))
    assert a == pytest.approx(2, rel=0.25) and b == pytest.approx(6, rel=0.25)


def test_targets(llm):
    sizes = [("a", 10), ("b", 1000), ("B", 5), ("é", 300), (None, 0), ("z", 50), ("", 20)]
    df = llm.createDataFrame(sizes, "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    order = ["", "B", "a", "b", "z", "é", None]
    size, weight = dict(sizes), {s: k % 3 + 1 for k, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        free = sum(weight[s] for s in size if s not in full)
        new = {s for s in size if s not in full and left * weight[s] / free > 3 * size[s]} if free else set()
        if not new:
            break
        full |= new
    for s in size:
        assert got[s] == pytest.approx(3 * size[s] if s in full else left * weight[s] / free)


def test_mix(llm, docs):
    rows = [(i, "word " * (1 + i % 40), ["a", "b", None][i % 3] if i % 2 else "hot") for i in range(600)]
    rows += [(None, None, "empty"), (5, "word " * 6, "hot"), (5, "word " * 6, "hot")]
    got = mixing.mix(docs(*rows)).select("row.doc_id", "row.source", "size", "source_size", "target", "taken", "copies").collect()
    assert len(got) == len(rows)
    assert all(r["taken"] == r["size"] * r["copies"] <= 3 * r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    by_source = defaultdict(set)
    for r in got:
        by_source[r["source"]].add(r["copies"])
    assert all(max(c) - min(c) <= 1 for c in by_source.values())  # whole epochs come first
    again = mixing.mix(docs(*reversed(rows)).repartition(7)).select("row.doc_id", "taken").collect()
    assert sorted([(r[0], r[1]) for r in again], key=repr) == sorted([(r["doc_id"], r["taken"]) for r in got], key=repr)
    out = mixing.mixed(docs(*rows))
    assert out.columns == docs().columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs()).count() == 0


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_mix_of_any_bucket_size(docs, monkeypatch, buckets):
    """The cut is where sorting a whole source would put it, and as near to the target as a document allows."""
    rows = [(i, "word " * (1 + i * 7 % 23), "ab"[i % 2] if i % 5 else "hot") for i in range(300)] + [(7, None, "a"), (9, "", "hot")]
    answer = lambda: sorted(mixing.mix(docs(*rows)).where("size > 0").select("row.doc_id", "row.source", "size", "target", "taken").collect())
    usual = answer()
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    assert answer() == usual
    for s in ("a", "b", "hot"):
        own = [r for r in usual if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2


def test_quality_weighs(llm, docs):
    rows = [(i, f"w{i} " * 10, "a" if i < 2000 else "b") for i in range(4000)]
    weight = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(F.when(F.col("doc_id") == 1, None).otherwise(0.5))
    got = mixing.mix(docs(*rows), quality=weight, weights=(1.0, 3.0)).where("row.source = 'a'")
    n = {r[0]: r[1] for r in got.groupBy(F.col("row.doc_id") % 2).agg(F.sum("copies")).collect()}
    assert n[0] > 2 * n[1]


def test_licenses(llm, docs):
    mit = license_scan.NOTICES["mit-text"]
    w = mit.split()
    rows = [
        (1, None), (2, ""), (3, "Released under the MIT license!"), (4, "filler " * 333 + mit + " filler" * 50), (5, LONG),
        (6, " ".join(w[:9] + ["changed"] + w[10:])), (7, " ".join(w[: len(w) // 2])), (None, "licensed under CC BY-NC 4.0"),
        (3, "Released under the MIT license!"), (8, license_scan.NOTICES["apache-2.0-header"]), (9, "under the MIT License Released"),
    ]
    got = license_scan.scan(docs(*rows), license_scan.notices(llm))
    out = {r["id"]: (r["copies"], r["licenses"]) for r in got.collect()}
    assert out[1] == out[2] == (1, []) and out[3] == (2, ["mit"]) and out[4] == (1, ["mit-text"])
    assert out[5][1] == [] and out[6][1] == ["mit-text"] and out[7][1] == [] and out[9][1] == []
    assert out[None][1] == ["cc-by-nc-4.0"] and out[8][1] == ["apache-2.0", "apache-2.0-header"]
    assert license_scan.scan(docs(), license_scan.notices(llm)).count() == 0
    assert license_scan.scan(docs((1, "a")), license_scan.notices(llm).limit(0)).count() == 1


def test_licenses_shuffled_templates(llm, docs, monkeypatch):
    """More template shingles than are broadcast; a text of 30,000 words, copies, null ids."""
    w = license_scan.NOTICES["bsd"].split()
    rows = [
        (1, None), (2, "Released under the MIT license!"), (2, "Released under the MIT license!"), (3, LONG + " All rights reserved. " + LONG),
        (None, "x " * 40 + " ".join([*w[:-1], "changed"]) + " y" * 40), (None, "x"), (4, " ".join(w[:9])), (5, "ALL RIGHTS RESERVED"),
    ]
    answer = lambda: sorted(map(tuple, license_scan.scan(docs(*rows), license_scan.notices(llm)).collect()), key=repr)
    usual = answer()
    monkeypatch.setattr(license_scan, "BROADCAST_SHINGLES", 0)
    assert answer() == usual
    got = {(r[0], r[2]): r[3] for r in usual}
    assert got[2, 2] == ["mit"] and got[3, 1] == got[5, 1] == ["all-rights-reserved-notice"] and got[4, 1] == got[1, 1] == []
    assert sorted(r[3] for r in usual if r[0] is None) == [[], ["bsd"]]
    assert license_scan.scan(docs(), license_scan.notices(llm)).count() == 0


def test_short_licenses(llm, docs):
    """Templates of one to four words are found word by word, in texts of any length."""
    texts = llm.createDataFrame(
        [("one", "Copyleft"), ("two", "Public Domain"), ("three", "All rights reserved."), ("four", "free for any use"), ("same", "ALL RIGHTS RESERVED"),
         ("none", "..."), ("null", None), ("five", "you may copy this freely"), (None, "no name")], "license string, text string")
    rows = [
        (1, "All rights reserved."), (2, "x " * 700 + "(all Rights-RESERVED!)"), (3, "all rights are reserved"), (4, "copyleft: public domain, public; domain"),
        (5, "free for any use"), (6, "free for any"), (7, None), (8, "..."), (9, "You may copy this freely. All rights reserved. All rights reserved"),
        (1, "All rights reserved."), (10, "no name"), (11, "copyleftx all rights"),
    ]
    out = {r["id"]: r for r in license_scan.scan(docs(*rows), texts).collect()}
    want = {1: ["same", "three"], 2: ["same", "three"], 3: [], 4: ["one", "two"], 5: ["four"], 6: [], 7: [], 8: [], 9: ["five", "same", "three"], 10: [], 11: []}
    assert {d: r["licenses"] for d, r in out.items()} == want and out[1]["copies"] == 2
    assert [m["license"] for m in out[10]["matches"]] == [None]
    assert [m["start"] for m in out[9]["matches"] if m["license"] == "three"] == [5, 8]
    assert [m["start"] for m in out[2]["matches"]] == [700, 700]


def test_license_query_with_short_notices(llm, sf):
    """Short notices against plain search for their words, the others against all windows."""
    words = {name: brute.WORD.findall(brute.low(text)) for name, text in license_scan.NOTICES.items()}
    sets = {name: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for name, w in words.items()}
    got = {r["doc_id"]: r["licenses"] for r in QUERIES["op8_license_scan"](llm, sf).collect()}
    short = 0
    for doc, text in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        w = brute.WORD.findall(brute.low(text))
        s = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        found = []
        for name, x in sets.items():
            if not x:
                there = f" {' '.join(words[name])} " in f" {' '.join(w)} "
                short += there
            else:
                c = 1 << (len(x) - 1).bit_length()
                there = any(len(x & set(s[a * c : a * c + 2 * c])) >= 0.8 * len(x) for a in range(len(s) // c + 1))
            if there:
                found.append(name)
        assert got[doc] == ",".join(sorted(found))
    assert short > 0
