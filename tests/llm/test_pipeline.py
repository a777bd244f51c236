"""The pipeline's stages, each against brute force on what its predecessor kept."""

import corpus_pipeline
from lakeops.llm import quality_rules
from lakeops.llm.queries import tokenizer_file
from lakeops.session import materialise
from tests.llm import brute


def test_stages(llm, sf):
    from tokenizers import Tokenizer

    docs = llm.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(llm, docs, sf), name)
        assert docs.columns == columns
        kept.append(docs.collect())
    source, good, single, clean, mix = kept
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    pairs = lambda rows: [(r["doc_id"], r["text"]) for r in rows]

    verdict = quality_rules.judge(llm.read.parquet(f"{sf}/documents.parquet")).where("kept").select("row.doc_id").collect()
    assert ids(good) == ids(verdict)
    assert all(not brute.quality(r["text"])[5] for r in good)
    assert ids(single) == sorted(d for d, _, c in brute.similar_groups(pairs(good)) if d == c)
    items = [(r["item_id"], r["text"]) for r in llm.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids(clean) == sorted(r[0] for r in brute.contamination(pairs(single), items) if not r[5])
    assert set(ids(mix)) <= set(ids(clean))
    size = sum(len(brute.SPACED.findall(r["text"])) for r in clean)
    mixed = sum(len(brute.SPACED.findall(r["text"])) for r in mix)
    assert abs(mixed - size) < 0.2 * size and len(mix) > len(set(ids(mix)))

    got = corpus_pipeline.run(llm, sf).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file())
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute.encoded(pairs(mix), tokenizer)
    assert {len(r) for r in source} == {5}
