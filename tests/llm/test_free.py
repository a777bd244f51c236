"""Token grammars, Jaccard join, personal data, line dedup, WARC, main text."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeops.llm import html_main, jaccard_join, line_dedup, pii, token_grammar, warc
from lakeops.llm.queries import QUERIES, tokenizer_file
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


# --- token grammars


def stream(documents):
    """Documents one after the other, each with the mark of its end."""
    return np.concatenate([x for d in documents for x in (d, np.array([0xFFFFFFFF], np.uint32))]).astype(np.uint32)


def test_re_pair_round_trip():
    rng = np.random.default_rng(1)
    for first, n in ((50, 5000), (3, 4000), (2, 3000), (50, 1), (50, 0)):
        ids = [rng.integers(0, first, int(k)).astype(np.uint32) for k in rng.integers(0, 60, n // 30 + 1)]
        row = token_grammar.make_shard(0, list(range(len(ids))), stream(ids), max(first, 3), 2)
        shard = token_grammar.Shard(row)
        for i, want in enumerate(ids):
            full = np.append(want, 2)
            assert shard.document(i).tolist() == full.tolist()
            a, b = len(full) // 3, len(full) - len(full) // 4
            assert shard.ids_between(i, a, b).tolist() == full[a:b].tolist()


def test_re_pair_shrinks():
    ids = [np.array([1, 5, 9, 7] * 500, np.uint32)]
    row = token_grammar.make_shard(0, [1], stream(ids), 10, 2)
    assert len(row["symbols"]) // 3 < 100 and len(row["rules"]) > 0


def test_re_pair_leaves_no_frequent_pair():
    """Pairs of 24 and more become rules, in a small shard as well."""
    rng = np.random.default_rng(2)
    ids = [np.append([1, 5], rng.integers(10, 50, 4)).astype(np.uint32) for _ in range(30)]
    symbols, rules = token_grammar.re_pair(stream(ids), 50)
    assert rules.tolist() == [[1, 5]] and len(symbols) == 30 * 6
    ids = [(rng.zipf(1.4, int(k)) % 400).astype(np.uint32) for k in rng.integers(0, 80, 1000)]
    symbols, _ = token_grammar.re_pair(stream(ids), 400)
    left, right = symbols[:-1], symbols[1:]
    inside = (left != 0xFFFFFFFF) & (right != 0xFFFFFFFF)
    assert np.unique(np.stack([left, right], 1)[inside], axis=0, return_counts=True)[1].max() < 24


def test_sorted_pairs_of_wide_symbols():
    rng = np.random.default_rng(3)
    left, right = (rng.integers(0, 9, 3000).astype(np.uint32) for _ in range(2))
    for above in (10, 1 << 30):  # packed, and too wide for it
        order, pairs, counts = token_grammar._sorted_pairs(left, right, above)
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        want, n = np.unique(key, return_counts=True)
        assert pairs.tolist() == want.tolist() and counts.tolist() == n.tolist() and key[order].tolist() == sorted(key.tolist())


def test_tokens(llm, docs, path, tokenizer):
    rows = [
        (5, None), (3, ""), (-2, " \n"), (7, LONG), (1, "It's A.B, c.. d?! Ünï 12,3 <|endoftext|> x y İstanbul ΣΑΣ é, ２."),
        (8, "same"), (8, "same"), (9, "a," * 50), (None, "no id"),
    ]
    token_grammar.write_tokens(docs(*rows), f"{path}/t", tokenizer_file())
    got = token_grammar.read_documents(llm, f"{path}/t").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute.encoded(pairs(rows), tokenizer)
    token_grammar.write_tokens(docs(), f"{path}/e", tokenizer_file())
    assert token_grammar.read_documents(llm, f"{path}/e").count() == 0


def test_token_query(llm, sf, tokenizer):
    rows = llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op2_token_grammar"](llm, sf).collect()
    assert sorted(map(tuple, got)) == brute.encoded(pairs(rows), tokenizer)


def test_chunks_are_what_the_tokenizer_sees(tokenizer):
    """Random strings of everything that might be joined or split at a chunk's border."""
    rng = random.Random(9)
    pieces = ["a", "word", "The", "É", "e\u0301", "ß", "İ", "Σ", "ΑΣ", ".", ",", "..", "'s", "'", "12", "²", "-", "\u00a0", "\u2003", "\x1c", "\u200d",
              "<|endoftext|>", "日本", "ab.", "c,", "!", "\x00", "ﬁ", "Å"]
    encoder = token_grammar.ChunkEncoder(tokenizer_file())
    for _ in range(300):
        texts = ["".join(rng.choice(pieces) + rng.choice(["", "", " ", "\n", "\t "]) for _ in range(rng.randrange(30))) for _ in range(8)]
        got = encoder.encode(texts)
        want = [x for t in texts for x in (*tokenizer.encode(t, add_special_tokens=False).ids, 0xFFFFFFFF)]
        assert got.tolist() == want, texts


def test_words_of_every_letter(tokenizer):
    """Words go to the model alone, in the spelling of the byte-level step."""
    texts = [f"{a}{chr(i)}{b}" for i in range(0x21, 0x260) for a, b in (("", ""), ("no", "ted"), ("T", ","))]
    want = [x for t in texts for x in (*tokenizer.encode(t, add_special_tokens=False).ids, 0xFFFFFFFF)]
    assert token_grammar.ChunkEncoder(tokenizer_file()).encode(texts).tolist() == want


def test_special_tokens_in_other_case(tokenizer):
    """Only the exact form is a special token; the tokenizer looks for it before it lower-cases."""
    rng = random.Random(10)
    pieces = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|StartOfText|>", "<|", "|>", "The", "WORD.", "É,", "A<B", "x"]
    encoder = token_grammar.ChunkEncoder(tokenizer_file())
    for _ in range(200):
        texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(20))) for _ in range(6)]
        want = [x for t in texts for x in (*tokenizer.encode(t, add_special_tokens=False).ids, 0xFFFFFFFF)]
        assert encoder.encode(texts).tolist() == want, texts


def test_signs_are_cut_off_as_by_the_pattern():
    sign = rb"[!-/:-@\[-`{-~]"
    pattern = re.compile(
        rb"(%s)(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))(?=%s*(?:\s|\Z))" % (sign, sign)
    )
    rng = random.Random(11)
    pieces = [bytes([i]) for i in range(256)] + ["é".encode(), "×".encode(), "÷".encode(), "É".encode(), b"a.", b"z,)", b" ", b"\n", b"_", b"`~"]
    for _ in range(2000):
        text = b"\n" + b"".join(rng.choices(pieces, k=rng.randrange(40))) + b"\n"
        assert token_grammar.cut_signs(text) == pattern.sub(rb" \1", text)


def test_a_chunk_is_looked_up_once_for_many_texts(tokenizer):
    """However often a word occurs in a step, the model spells it once and the index is asked once."""
    encoder = token_grammar.ChunkEncoder(tokenizer_file())
    asked = []

    class Known(dict):
        def get(self, chunk, default=None):
            asked.append(chunk)
            return super().get(chunk, default)

    encoder.chunks = Known(encoder.chunks)
    texts = ["one two, one", b"two one two.", None, "One TWO"] * 50
    got = encoder.encode(texts).tolist()
    assert len(asked) == len(set(asked)) < 10
    plain = [t.decode() if isinstance(t, bytes) else t or "" for t in texts]
    assert got == [x for t in plain for x in (*tokenizer.encode(t, add_special_tokens=False).ids, 0xFFFFFFFF)]
    with pytest.raises(ValueError):
        encoder.encode([b"a \xff b"])


def test_stretches_of_any_length():
    rng = np.random.default_rng(6)
    flat = np.arange(100, dtype=np.uint32)
    for n in (0, 1, 2, 40, 400):
        sizes = rng.integers(0, 4, n)
        starts = rng.integers(0, 96, n)
        want = [x for a, k in zip(starts.tolist(), sizes.tolist()) for x in range(a, a + k)]
        assert token_grammar.gather(flat, starts, sizes).tolist() == want
        assert token_grammar.unpack24(token_grammar.pack24(starts + (1 << 20))).tolist() == (starts + (1 << 20)).tolist()
    assert token_grammar.gather(flat, starts, 0 * sizes).tolist() == []


def test_texts_are_taken_by_their_bytes(monkeypatch):
    monkeypatch.setattr(token_grammar, "TEXT_BYTES", 10)
    texts = ["a" * 4, None, "é" * 3, "", "b" * 30, "c", "d" * 9, "e"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(8)), "text": texts})
    parts = [p.column("text").to_pylist() for p in token_grammar.by_bytes(batch)]
    assert [t for p in parts for t in p] == texts
    assert [len(p) for p in parts] == [3, 2, 2, 1]
    assert list(token_grammar.by_bytes(batch.slice(0, 0))) == []


def test_pairs_are_counted_on_as_if_counted_anew():
    """What every symbol stands for is as after rounds that count all pairs again."""

    def plain(symbols, first_rule, least):
        symbols, rules = symbols.tolist(), []
        while True:
            inside = [p for p in zip(symbols, symbols[1:]) if 0xFFFFFFFF not in p]
            counts = Counter(inside)
            top = max(counts.values(), default=0)
            if top < least:
                return symbols, rules
            bound, out, used, i = max(least, top // token_grammar.STEP), [], set(), 0
            frequent = {p for p, n in counts.items() if n >= bound}
            while i < len(symbols):
                pair = tuple(symbols[i : i + 2])
                out.append(pair if pair in frequent else symbols[i])
                used |= {pair} & frequent
                i += 1 + (pair in frequent)
            new = {p: first_rule + len(rules) + k for k, p in enumerate(sorted(used))}
            rules += [list(p) for p in new]
            symbols = [new.get(s, s) if isinstance(s, tuple) else s for s in out]

    def spell(s, rules):
        return [s] if s < 60 or s == 0xFFFFFFFF else [x for half in rules[s - 60] for x in spell(half, rules)]

    rng = np.random.default_rng(4)
    for _ in range(60):
        symbols = (rng.zipf(1.3, int(rng.integers(1, 800))) % int(rng.integers(2, 60))).astype(np.uint32)
        symbols[rng.random(len(symbols)) < 0.03] = 0xFFFFFFFF
        got, rules = token_grammar.re_pair(symbols, 60, 4)
        want, expected = plain(symbols, 60, 4)
        rules = rules.tolist()
        assert [spell(s, rules) for s in got.tolist()] == [spell(s, expected) for s in want]


def test_rare_pairs_are_neither_sorted_nor_looked_for(monkeypatch):
    """Next to a new symbol most pairs are rare; only those that may be frequent are sorted."""
    asked, sort = [], token_grammar._sorted_pairs
    monkeypatch.setattr(token_grammar, "_sorted_pairs", lambda left, *more: asked.append(len(left)) or sort(left, *more))
    others = np.random.default_rng(12).permutation(5000).astype(np.uint32) + 10
    symbols = np.stack([np.full(5000, 1, np.uint32), np.full(5000, 2, np.uint32), others], 1).ravel()
    got, rules = token_grammar.re_pair(symbols, 6000)
    assert rules.tolist() == [[1, 2]] and got.tolist() == [x for o in others.tolist() for x in (6000, o)]
    assert len(asked) == 2 and asked[1] == 0


def test_different_chunks_make_up_the_text():
    rng = random.Random(13)
    pieces = [b"a", b"\0", b"ab", b"abcdefg", b"abcdefgh", b"abcdefg\0", b"\xff", b"\xc3\xa9", b" ", b" ", b" "]
    for _ in range(500):
        text = b"".join(rng.choices(pieces, k=rng.randrange(60))) + b" "
        different, which = token_grammar.different_chunks(text)
        chunks = [token_grammar._bytes(c) for c in different]
        assert len(set(different)) == len(set(chunks)) == len(chunks)
        assert [chunks[i] for i in which.tolist()] == text[:-1].split(b" ")


# --- Jaccard join


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"m{rng.randrange(10**6)}"
    return " ".join(words)


def check_join(docs, rows):
    got = jaccard_join.join_similar(docs(*rows)).collect()
    want = brute.similar_groups(pairs(rows))
    assert sorted(map(tuple, got)) == want
    return want


def test_join_small_sets(docs):
    """Sizes at which an empty part of the domain is likely and single shingles decide."""
    rng = random.Random(3)
    rows = []
    for size in (1, 2, 4, 5, 6, 8, 9, 10, 12, 14, 18, 25, 40):
        for _ in range(4):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            rows.append((len(rows), " ".join(base)))
            rows.append((len(rows), " ".join(base + ["tail"])))
            rows.append((len(rows), " ".join([*base, "Tail"]).upper()))
            rows.append((len(rows), mutated(rng, base, 1)))
            rows.append((len(rows), " ".join(base[1:]) or "single"))
    want = check_join(docs, rows)
    assert len({c for _, _, c in want}) < len(rows) * 0.8


def test_join_border(docs):
    """Pairs around the threshold, across the borders of size bands."""
    rng = random.Random(4)
    rows = []
    for size in (30, 60, 61, 96, 150, 240, 380, 600):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        rows.append((len(rows), " ".join(base)))
        for share in (0.02, 0.04, 0.05, 0.1, 0.2, 0.24, 0.25, 0.26):
            rows.append((len(rows), " ".join(base + [f"x{i}" for i in range(int(share * size))])))
            rows.append((len(rows), mutated(rng, base, max(1, int(share * size / 5)))))
    check_join(docs, rows)


def test_join_chains_and_stars(docs):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    rows += [(1 + i, mutated(rng, base, 3)) for i in range(40)]  # linked to the first, hardly to each other
    for i in range(60):  # a chain that drifts
        base = [*base[3:], *(f"c{i}_{j}" for j in range(3))]
        rows.append((len(rows), " ".join(base)))
    rng.shuffle(rows)
    check_join(docs, rows)


def test_join_edge_cases(docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, LONG), (6, "a"), (7, "A"), (8, "a b c d"), (9, "a b c d e")]
    got = {r["id"]: r["component"] for r in jaccard_join.join_similar(docs(*rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 9}
    assert jaccard_join.join_similar(docs()).count() == 0
    odd = jaccard_join.join_similar(docs((None, "x y z"), (3, "x y z"), (3, "x y z"), (2, "x y z"))).collect()
    assert sorted([(r["id"], r["component"]) for r in odd], key=repr) == [(2, 2), (3, 2), (3, 2), (None, None)]


def test_one_of_each(docs):
    rows = [(1, "p q r"), (2, "P q r"), (3, None), (3, None), (4, "z z z"), (4, "z z z"), (None, "p q r"), (5, "u v")]
    left = jaccard_join.one_of_each(docs(*rows))
    assert left.columns == docs().columns
    assert sorted([tuple(r) for r in left.select("doc_id", "text").collect()], key=repr) == sorted(
        [(1, "p q r"), (3, None), (3, None), (4, "z z z"), (None, "p q r"), (5, "u v")], key=repr
    )


# --- personal data


def test_base_spans():
    rng = random.Random(6)
    pieces = ["a@b.co", "x.y+z@mail-1.example.com", "@", "a@b", "..@c.d", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "4111 1111-1111 1111",
              "4111111111111112", "+1 (555) 010-0000", "+12", "++1 2 3 4 5 6 7 8 9 0", "+1 555 010 0000 ext", "é", " ", "\n", "12", "-", "5555555555554444", ".", "a@b.c@d.e"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == brute.base_spans(text), text
    for text in ("0" * 5000 + "1.1.1.1", "1.1.1." + "0" * 5000, "1.1.1." + "9" * 5000, "1.2.3." + "0" * 5000 + "256"):
        assert pii.base_spans(text) == brute.base_spans(text)


def test_scanning_is_linear():
    for unit in ("1", "a", "a@", "1.", "1 ", "+1", "a.", "token=", "AB12 ", "(1)"):
        text = unit * (200_000 // len(unit))
        pii.base_spans(text)


def test_trees_on_held_out_candidates():
    model = pii.train()
    x, y = pii.labelled(3000, seed=77)
    p = model.trees.predict(x)
    chosen = p >= np.array(model.thresholds)[x[:, 0].astype(int)]
    assert y[chosen].mean() >= 0.98 and chosen[y == 1].mean() >= 0.9


def test_added_spans(llm, docs):
    rows = [
        (1, None), (2, ""), (3, "password=c1f6c02f845bf3028d de"), (4, "the password: required here"), (5, "in 1999 and version 1.2.3"),
        (6, "write me@x.org or call"), (6, "write me@x.org or call"), (7, LONG),
    ]
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs(*rows)).select("row.doc_id", "spans").collect()}
    assert got == {1: "", 2: "", 3: "secret:9:27", 4: "", 5: "", 6: "email:6:14", 7: ""}
    red = pii.find(docs(*rows)).where("row.doc_id = 6").first()["redacted"]
    assert red == "write [email] or call"
    assert pii.find(docs()).count() == 0


@pytest.mark.parametrize("name", ["clientSecret=", "dbpassword: ", 'accessToken: "', "DB_PASSWORD=", "credentials: ", "passwords = "])
def test_compound_secret_names(name):
    model = pii.train()
    for value in ("q8Zk3pLw9", "hunter22x", "9f8e7d6c5b4a39281706"):
        text = f"der the {name}{value} of"
        assert (len(f"der the {name}"), len(f"der the {name}{value}"), "secret") in model.spans(text)[1], text


def test_long_secrets_are_whole():
    """Nothing of a secret is left over, however long it is and wherever its first digit stands."""
    rng, model = random.Random(8), pii.train()
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for lead in ("token=", "client_secret: ", ""):
        for n in (150, 199, 201, 320, 1000, 5000):
            value = "".join(rng.choice(alnum) for _ in range(n))
            spans = model.spans(f"der die {lead}{value} of the")[1]
            assert spans == [(8 + len(lead), 8 + len(lead) + n, "secret")], (lead, n)
            assert pii.redact(f"der die {lead}{value} of the", spans) == f"der die {lead}[secret] of the"
    late = "".join(rng.choice(alnum[:52]) for _ in range(90)) + "".join(rng.choice(alnum) for _ in range(90)) + "7"
    assert (4, 4 + len(late), 1) in [(c.start, c.end, c.generator) for c in pii.candidates_of(f"the {late} of")]


def test_proposing_is_linear():
    for unit in ("1", "a", "=", "a1", "token", "token=", "token:a ", "secret_", "-/", "a1= "):
        pii.candidates_of(unit * (200_000 // len(unit)))


def test_selecting_is_linear():
    model = pii.train()
    for unit in ("tel: 555-867-5309 ", "a@b.co 12-34-56 ", "x at y dot z ", "token=a1b2c3 ", "1.2.3.4 "):
        took = []
        for n in (5_000, 40_000):
            start = time.process_time()
            model.spans(unit * (n // len(unit)))
            took.append(time.process_time() - start)
        assert took[1] < 20 * took[0] + 0.5, unit


def test_candidates_do_not_depend_on_signs_elsewhere():
    text = "write john at example dot com please"
    spans = [(c.start, c.end) for c in pii.candidates_of(text)]
    assert spans == [(c.start, c.end) for c in pii.candidates_of(text + ": ok")] != []


def test_long_candidates_are_whole():
    local = "a" * 200
    found = [(c.start, c.end) for c in pii.candidates_of(f"to {local}(at){local}.x now")]
    assert found == [] or (3, 3 + 200) not in found
    text = f"to {local} at b dot c dot d dot e dot f dot g dot com"
    assert (3, len(text)) in [(c.start, c.end) for c in pii.candidates_of(text)]


def test_personal_data_query(llm, sf):
    rows = llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op4_personal_data"](llm, sf).collect()}
    for doc, text in rows:
        base = brute.base_spans(text or "")
        told = [f"{k}:{s}:{e}" for s, e, k in base]
        assert got[doc]["base_sha256"] == brute.sha(",".join(told))
        assert set(told) <= set(got[doc]["spans"].split(",")) or not told
        assert [got[doc][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[2] == k for x in base) for k in pii.BASE_KINDS]


# --- lines


def line_rows():
    rng = random.Random(8)
    hot, rare = [f"Hot line {i}" for i in range(8)], [f"line {i}" for i in range(400)]
    rows = [(i, "\n".join(rng.choice([hot[i % 8], " " + hot[(i * 3) % 8].upper() + "\t", rng.choice(rare), "", f"own {i}"]) for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    return [*rows, (200, None), (201, ""), (202, "\n\n"), (203, LONG), (200, "Hot line 1"), (200, "Hot line 1"), (None, "hot line 2\r")]


def cleaned(df):
    return sorted([tuple(r) for r in df.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()], key=repr)


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_lines(docs, monkeypatch, limit):
    """In one pass, and by joins where the filters are too large."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
    rows = line_rows()
    df = docs(*rows)
    got = cleaned(line_dedup.clean(df, line_dedup.build(df)))
    assert got == sorted(brute.dedup_lines(pairs(rows)), key=repr)


def test_lines_reversible(llm, docs):
    rows = line_rows()
    first, second = rows[:70], rows[70:]
    index = line_dedup.build(docs(*first))
    both = line_dedup.insert(llm, index, docs(*second))
    assert cleaned(line_dedup.clean(docs(*rows), both)) == sorted(brute.dedup_lines(pairs(rows)), key=repr)
    back = line_dedup.delete(llm, both, docs(*second))
    assert cleaned(line_dedup.clean(docs(*first), back)) == sorted(brute.dedup_lines(pairs(first)), key=repr)
    count = lambda i: sorted(map(tuple, i.counts(llm).collect()))
    assert count(back) == count(index)
    assert line_dedup.clean(docs(), line_dedup.build(docs())).count() == 0


@pytest.mark.parametrize("start", [0, 70])
def test_shards_grow_with_the_frequent_keys(llm, docs, monkeypatch, start):
    """An index of an empty or a small batch is not left with one shard for all later keys."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 2)
    rows = line_rows()
    small = line_dedup.build(docs(*rows[:start]))
    grown = line_dedup.insert(llm, small, docs(*rows[start:]))
    n = grown.counts(llm).where(F.col("docs") >= grown.threshold).count()
    assert small.shards < grown.shards and n <= 2 * grown.shards < 2 * n
    assert cleaned(line_dedup.clean(docs(*rows), grown)) == sorted(brute.dedup_lines(pairs(rows)), key=repr)
    back = line_dedup.delete(llm, grown, docs(*rows[start:]))
    assert cleaned(line_dedup.clean(docs(*rows[:start]), back)) == sorted(brute.dedup_lines(pairs(rows[:start])), key=repr)
    again = line_dedup.insert(llm, back, docs(*rows[start:]))
    assert again.shards == grown.shards
    assert cleaned(line_dedup.clean(docs(*rows), again)) == sorted(brute.dedup_lines(pairs(rows)), key=repr)


def test_cuckoo():
    keys = [line_dedup.digest(str(i).encode()) for i in range(3000)]
    f = line_dedup.filled(keys)
    assert f.contains(keys).all()
    others = [line_dedup.digest(f"o{i}".encode()) for i in range(20_000)]
    assert f.contains(others).mean() < 0.002
    f.delete(keys[:1500])
    assert f.contains(keys[1500:]).all() and f.contains(keys[:1500]).mean() < 0.01
    again = line_dedup.CuckooFilter.from_bytes(f.to_bytes())
    assert again.insert(keys[:1500]) and again.contains(keys).all()


# --- WARC


def test_archives(llm, path):
    big, other = "é<p>" * 300, "x" * 1000
    rows = [
        (1, "http://a/", big), (2, "http://b/?q=1%20\r\nX: y", big), (9, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None),
        (6, "u", ""), (7, "ü", other), (7, "ü", other), (None, "n", big), (8, "line\r\n\r\nbreak", "WARC/1.1\r\n\r\nbody\r\n\r\n" * 80), (10, "u", "y" * 999), (11, "u", "y" * 999),
    ]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    index = warc.write_archives(pages, f"{path}/w")
    got = warc.read_payloads(llm, index, index, f"{path}/w").collect()
    said = sorted([(r["page_id"], r["url"], bytes(r["payload"]).decode(), r["record_type"], r["refers_to"]) for r in got], key=repr)
    refers = {1: 9, 2: 9, None: 9}
    want = [(p, u, h or "", "revisit" if p in refers else "response", refers.get(p)) for p, u, h in rows]
    assert said == sorted(want, key=repr)
    some = warc.read_records(index.where("url = 'u'"), f"{path}/w")
    assert some.count() == 6
    assert warc.read_records(warc.write_archives(pages.limit(0), f"{path}/e"), f"{path}/e").count() == 0


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.MAX_GAP + 1, 3), ("b", 0, warc.MAX_READ), ("b", warc.MAX_READ, 1)]
    got = [(f, s, e, len(r)) for f, s, e, r in warc.ranges(iter(rows))]
    far = 15 + warc.MAX_GAP + 1
    assert got == [("a", 0, 15, 2), ("a", far, far + 3, 1), ("b", 0, warc.MAX_READ, 1), ("b", warc.MAX_READ, warc.MAX_READ + 1, 1)]


# --- main text

PARA = "The cat of the house and the dog was in a garden with the owner, and it is not known what the two of them were on to there."


def test_main_text_of_an_odd_page():
    page = f"""<!doctype html><html><head><title>No</title><script>if (a<b) "<p>no</p>"</script><style>p{{}}</style></head>
    <body class="page has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">{PARA}</div><div id="sidebar"><p>{PARA}</p></div>
    <main><article><h2>Head &amp; line</h2><p>{PARA}<p>Sh<b>or</b>t&nbsp;one.<br>Next</p><!-- <p>no</p> -->
    <div class="ad">Buy <p>now</p></div><form><p>{PARA}</p></form><ul><li>one<li>two</ul>
    <p>{PARA}</p><section id="comments"><article class="comment"><p>{PARA}</p></article></section></article></main>
    <aside>{PARA}</aside><footer>&copy; nobody</footer></body></html>"""
    assert html_main.main_text(page) == f"Head & line {PARA} Short one. Next one two {PARA}"


def test_main_text_without_article():
    body = f"<div><p>{PARA}</p><p>Short.</p><p>{PARA}</p></div>"
    page = f"<body><div class=menu><a href=a>One</a> <a href=b>Two</a></div>{body}<div><a href=x>A link that leads</a></div><p>Short end"
    # the short block after the links takes after them
    assert html_main.main_text(page) == f"{PARA} Short. {PARA}"


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "</p></div>", "<script>x", "&amp;", "<div " + "a" * 5000, "<b>" * 3000, "<p>" * 3000])
def test_main_text_of_broken_pages(page):
    assert html_main.main_text(page) == ""


@pytest.mark.parametrize("unit", ["<a ", '<a "', '"<a ', "<b>", "</i>", "<a<a", "<p><b>", "<article>", "<a '\"", "<!", "</script "])
def test_main_text_takes_linear_time(unit):
    start = time.process_time()
    html_main.main_text(unit * (500_000 // len(unit)))
    assert time.process_time() - start < 20


def test_main_text_of_deeply_open_pages():
    start = time.process_time()
    html_main.main_text("<b>" * 100_000 + "</i>" * 100_000 + "<article></article>" * 10_000 + "<p></p>" * 10_000)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("text", [
    "Сегодня комитет по делам города собрался, чтобы обсудить новый план развития улиц и площадей, который был представлен осенью. " * 3,
    "Oggi il comitato della città si è riunito per discutere il nuovo piano di sviluppo delle strade che era stato presentato. " * 3,
    "今天城市委员会开会讨论新的街道和广场发展计划，该计划是在秋天提出的。" * 5,
])
@pytest.mark.parametrize("around", ["div", "article"])
def test_main_text_in_other_languages(text, around):
    menu = "<div class='nav'><a href='/'>Home</a></div><div><a href='/a'>One link</a> <a href='/b'>and another link</a></div>"
    page = f"<html><body>{menu}<{around}><p>{text}</p><p>{text}</p></{around}></body></html>"
    assert html_main.main_text(page) == f"{text.strip()} {text.strip()}"


def test_linked_sentences_of_an_article_stay():
    plain = "The committee met on the new plan of the city and it was a long day for all of us in the hall."
    linked = "See the <a href='x'>report of the committee on the plan for the streets of the town</a> today."
    text = html_main.main_text(f"<article><p>{plain}</p><p>{linked}</p><p>{plain}</p><p><a href='y'>Read more here</a></p></article>")
    assert text == f"{plain} See the report of the committee on the plan for the streets of the town today. {plain}"


def test_main_text_query(llm, sf):
    rows = llm.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op7_main_text"](llm, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = brute.article(r["html"])
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])


def test_main_text_frames(llm):
    df = llm.createDataFrame([(1, "<article>x</article>", "a"), (1, "<article>x</article>", "a"), (None, None, None)], "page_id bigint, html string, text string")
    got = html_main.extract(df).select("row.page_id", "row.text", "text", "n_chars").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "a", "x", 1), (1, "a", "x", 1), (None, None, "", 0)]
    assert html_main.extract(df.limit(0)).count() == 0
