"""Prefix BPE, vector codes and the Merkle manifest against brute force."""

import hashlib
import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakeops.llm import merkle, prefix_bpe, vector_codes
from lakeops.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def bpe():
    return prefix_bpe.PrefixBpe(tokenizer_file())


def agree(bpe, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert bpe.encode(text) == want, text[:200]
    assert bpe.decode(want) == library.decode(want, skip_special_tokens=False)


ODD = [*"aabbeeinttsoorhu' .,!?0123ABCÉéßΣσİ́\x00\x1c\x85 中文字😀👍🏽ﬁǅ‍-_<|>\t\n", "<|endoftext|>", "<|StartOfText|>", "<|startoftext|>", "'LL", "ing", "the"]


def test_random_texts(bpe, library):
    rng = random.Random(5)
    for _ in range(3000):
        agree(bpe, library, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))))


def test_words_made_of_pieces(bpe, library):
    rng, pieces = random.Random(6), [p.replace("</w>", "") for p in library.get_vocab() if p.isascii()]
    for _ in range(3000):
        agree(bpe, library, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))))


@pytest.mark.parametrize("text", ["a" * 4001, "ab" * 3000, "aaab" * 1001, "hah" * 2000, "!" * 3000, "é" * 3000, "ΑΣ ΣΑΣ", "", " \t\n", "\x1c", "<|endoftext|>" * 50])
def test_long_and_odd_texts(bpe, library, text):
    agree(bpe, library, text)


def test_every_token_that_is_found_encodes_to_itself(bpe):
    for spelled, (token, _) in list(bpe.automaton.items())[::37]:
        assert bpe.word(spelled) == [token]


def test_encoding_is_linear(bpe):
    took = []
    for n in (10_000, 40_000):
        start = time.process_time()
        bpe.encode("abcdefghijklmnopqrstuvwxyz" * n)
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0] + 0.5


def test_forgotten_chunks(library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "_CACHE_SIZE", 3)
    monkeypatch.setattr(prefix_bpe, "_CACHE_PAIRS", 3)
    small = prefix_bpe.PrefixBpe(tokenizer_file())
    for text in ("some words, and some more words!", "others; and some 123 words again") * 3:
        agree(small, library, text)


def test_bpe_frames(llm, docs, library):
    texts = [None, "", "  ", "Hello wörld's 1a", "Hello wörld's 1a", "x" * 50_000]
    df = docs(*[(i if i != 4 else 3, t) for i, t in enumerate(texts)])
    found = prefix_bpe.decode(prefix_bpe.encode(df, tokenizer_file()), tokenizer_file()).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = sorted((r["row"]["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"], r["n_tokens"]) for r in found)
    assert got == sorted((i if i != 4 else 3, w, library.decode(w, skip_special_tokens=False), len(w)) for i, w in enumerate(want))
    assert prefix_bpe.encode(df.where("false"), tokenizer_file()).count() == 0


def test_bpe_query(llm, sf, library):
    texts = dict(llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = contract.queries()["op11_prefix_bpe"](llm, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# vector codes


def lloyd(rows):
    """(vec_id, label, vector) rows: the contract with Python's integers."""
    usable = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = [[math.floor(1024 * x) if abs(x) < 2**40 else int(x) * 1024 for x in r[2]] for r in usable]
    size = len(whole[0]) // 4
    parts = [[w[p * size : (p + 1) * size] for w in whole] for p in range(4)]
    books = [[list(x) for x in part[:256]] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(4):
        for part, book in zip(parts, books):
            members = {}
            for x in part:
                members.setdefault(nearest(x, book)[1], []).append(x)
            for k, xs in members.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], {}
    for i, r in enumerate(usable):
        found = [nearest(parts[p][i], books[p]) for p in range(4)]
        error = min(sum(min(d, 2**63 - 1) for d, _ in found), 2**63 - 1)
        by_label[r[1]] = by_label.get(r[1], 0) + error
        out.append((r[0], "".join(f"{k:02x}" for _, k in found), error, r[1]))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted([(i, c, e, min(by_label[label], 2**63 - 1)) for i, c, e, label in out], key=str), digest


def coded(llm, rows, kind="array<float>"):
    df = llm.createDataFrame(rows, f"vec_id bigint, label int, embedding {kind}")
    df = df.withColumns({c: F.lit(7) for c in ("x", "id", "salt", "row", "entry", "code", "error")})
    books = vector_codes.learn(df)
    found = vector_codes.with_label_errors(vector_codes.encode(df, books)).collect()
    got = [(r["row"]["vec_id"], r["code"], r["error"], r["label_error"]) for r in found]
    return sorted(got, key=str), vector_codes.codebook_digest(books)


def vectors(n, size, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i), int(i) % 3 if i % 5 else None, [float(np.float32(x)) for x in rng.normal(0, spread, size)]) for i in range(n)]


@pytest.mark.parametrize("owner_rows", [1 << 16, 50])
def test_codes(llm, monkeypatch, owner_rows):
    monkeypatch.setattr(vector_codes, "OWNER_ROWS", owner_rows)
    rows = vectors(700, 8, 1)
    assert coded(llm, rows) == lloyd(rows)


def test_codes_of_odd_vectors(llm):
    rows = vectors(300, 4, 2, 0.01)  # many parts fall on few integers: ties and unused entries
    rows += [(5, 1, rows[5][2]), (5, 1, rows[5][2]), (5, 1, rows[6][2]), (None, None, rows[7][2])]
    rows += [(900, 1, None), (901, 1, [0.0, None, 0.0, 0.0]), (902, 1, [0.0, math.nan, 0.0, 0.0]), (903, 1, [math.inf, 0.0, 0.0, 0.0])]
    assert coded(llm, rows) == lloyd(rows)


def test_codes_of_few_and_large_vectors(llm):
    few = [(i, None, [0.1 * i, -0.1, 3.0, -2.5]) for i in range(3)]
    assert coded(llm, few) == lloyd(few)
    large = [(i, 0, [1e17 * (i % 7), -1e17 + i, 1e300 if i == 4 else -3.7, float(i)]) for i in range(290)]
    assert coded(llm, large, "array<double>") == lloyd(large)


def test_codes_of_nothing(llm):
    assert coded(llm, [(1, 1, None)])[0] == []
    assert coded(llm, [])[0] == []
    empty = [(i, 1, []) for i in range(3)]
    assert coded(llm, empty)[0] == [(i, "00000000", 0, 0) for i in range(3)]
    for lengths in ((4, 8), (6, 6)):
        with pytest.raises(ValueError):
            coded(llm, [(i, 1, [1.0] * n) for i, n in enumerate(lengths)])


def test_only_movers_are_shuffled(llm, monkeypatch):
    """After the first round a member goes through a shuffle only if it changes its entry."""
    owned = []
    real = type(llm.range(1)).repartition

    def watched(self, *columns):
        out = real(self, *columns)
        if columns == ("pos", "entry", "salt"):
            owned.append(self.count())
        return out

    monkeypatch.setattr(type(llm.range(1)), "repartition", watched)
    vector_codes.learn(llm.createDataFrame(vectors(1000, 8, 3), "vec_id bigint, label int, embedding array<float>"))
    assert len(owned) == vector_codes.ROUNDS and owned[0] == 4000
    assert all(n < 2500 for n in owned[1:])


def test_sums_stay_exact_beyond_64_bits():
    totals = vector_codes.Totals(1)
    for _ in range(4):
        totals.add(np.zeros(2, int), np.zeros(2, int), np.array([[2.0**51], [2.0**51]]))
    totals.add(np.zeros(1, int), np.zeros(1, int), np.array([[10**30]], object))
    totals.add(np.zeros(1, int), np.ones(1, int), np.array([[-3.0]]))
    assert totals.sums[0, 0, 0] == 8 * 2**51 + 10**30 and totals.sums[0, 1, 0] == -3 and totals.counts[0, 0] == 9


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Root and, for each node, the runs on its way with its place in them."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for i, way in enumerate(ways):
            way.append((runs[at[i] // 8], at[i] % 8))
            at[i] //= 8
        nodes = [H(*r) for r in runs]
    return nodes[0], ways


def tree(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda r, text: H(*map(field, (r[0], r[3], r[2], r[4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    climbed = [climb([leaf(r, r[1]) for r in groups[g]]) for g in order]
    root, over = climb([c[0] for c in climbed])
    out = []
    for g, (subroot, ways), top in zip(order, climbed, over):
        for r, way in zip(groups[g], ways):
            path = way + top
            h, low = leaf(r, r[1]), r[1]
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            siblings = "".join("".join(run[:i] + run[i + 1 :]) for run, i in path)
            folded = leaf(r, low)
            for run, i in path:
                folded = H(*run[:i], folded, *run[i + 1 :])
            out.append((r[0], h, subroot, root, H(siblings), folded, folded == root))
    return sorted(out, key=str)


def proven(df):
    found = merkle.manifest(df, altered=merkle.lowered(df))
    rows = found.select(
        "row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
        merkle.fold(F.coalesce("altered_leaf", "leaf"), F.col("proof")).alias("f"),
    ).collect()
    return sorted([(*r, r["f"] == r["root"]) for r in rows], key=str)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(llm, rows):
    return llm.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in ("k", "o", "h", "p", "n", "r", "block", "path", "row")})


def some(n, lang, start=0):
    return [(start + i, f"Text {i} Ä" * (i % 5), lang, "s" if i % 3 else None, i) for i in range(n)]


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 1], [65, 8, 9], [1] * 9, [1] * 70, [513, 512, 3]])
def test_trees(llm, sizes):
    rows, at = [], 0
    for i, n in enumerate(sizes):
        rows += some(n, f"l{i:02d}", at)
        at += n
    assert proven(frame(llm, rows)) == tree(rows)


def test_tiers(llm, monkeypatch):
    """Blocks of one digit: the same trees from several tiers, for the groups as well."""
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows, at = [], 0
    for i, n in enumerate([600, 64, 65, 9, 8, 7, 1, 1, 1, 1, 2]):
        rows += some(n, f"l{i}", at)
        at += n
    assert proven(frame(llm, rows)) == tree(rows)


def test_odd_leaves(llm):
    rows = some(5, None) + some(4, "é", 50) + some(3, "z", 70) + some(2, "", 80) + some(1, "\U0001f600", 90)
    rows += [(None, None, None, None, None), (None, "A", "z", None, None), (3, "Other", None, "s", 1), rows[2], rows[2]]
    rows += [(99, "LONG " * 200_000, "z", "s", 1)]
    assert proven(frame(llm, rows)) == tree(rows)
    assert proven(frame(llm, rows).where("false")) == []


def test_no_join_emits_proofs(llm, sf):
    """Ranking joins group sizes; above the stored tiers there is no join."""
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    plan = merkle.manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_changed_leaf_is_found(llm):
    rows = some(100, "en")
    df = frame(llm, rows)
    found = merkle.manifest(df, altered=F.when(F.col("doc_id") == 42, F.lit("forged")))
    folded = found.select("row.doc_id", (merkle.fold(F.coalesce("altered_leaf", "leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert {r["doc_id"] for r in folded.where("NOT ok").collect()} == {42}
