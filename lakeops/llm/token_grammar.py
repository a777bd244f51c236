"""Token ids as Re-Pair grammars in shards.

Documents are put in ascending order of their id (range partitions, nulls last), encoded
with a public tokenizer and closed with an end id. A partition writes shards of about
``SHARD_IDS`` ids. Within a shard frequent pairs of symbols are replaced, round by round,
by new symbols; no pair reaches over the end of a document.

One shard is one row of a Parquet table, so any store that Spark writes to will do:

  part, shard          place in the global order
  doc_ids              ids of the documents, in order
  doc_tokens           number of ids of each document, with the end id
  doc_symbols          number of grammar symbols of each document
  n_tokens             sum of doc_tokens
  first_rule           the first symbol that is a rule; smaller ones are token ids
  end_id               the id that closes a document
  rules                pairs (left, right) of little-endian unsigned 32-bit numbers
  lengths              ids that each rule expands to, likewise
  symbols              the documents' symbols, little-endian unsigned 24-bit numbers

A document is decoded alone: its symbols start at the sum of the doc_symbols before it.
Inside it the lengths tell where an id lies without expanding what comes before.

Defined cases: a null text is empty and gives the end id alone; rows with the same id are
neighbours in an order of their own; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

SHARD_IDS = 1 << 21
#: Bytes of text that are encoded at once, to within a document.
TEXT_BYTES = 6 << 20
#: A rule must replace so many pairs in its shard.
MIN_PAIRS = 24
SHARD_SCHEMA = (
    "shard int, doc_ids array<bigint>, doc_tokens array<int>, doc_symbols array<int>, n_tokens bigint,"
    " first_rule int, end_id int, rules binary, lengths binary, symbols binary"
)
#: A round goes down to this fraction of the most frequent pair.
STEP = 4
_CACHE_CHUNKS = 1_500_000
_END = np.uint32(0xFFFFFFFF)
#: The chunk that ends a document. UTF-8 has no such byte.
_STOP = b"\xff"


_OTHER, _SPACE, _SIGN, _LETTER = range(4)


def _byte_kind(byte: int) -> int:
    one = bytes([byte])
    if one.isspace():
        return _SPACE
    if one.islower():
        return _LETTER
    return _SIGN if 0x20 < byte < 0x7F and not one.isalnum() else _OTHER


_KINDS = bytes(map(_byte_kind, range(256)))
#: A-Z to lower case, every white space to a space.
_FOLDED = bytes(b" "[0] if bytes([i]).isspace() else bytes([i]).lower()[0] for i in range(256))


def cut_signs(text: bytes) -> bytes:
    """A space before the signs that follow a word up to white space.

    The word ends in a lower-case letter of ASCII or a letter of the two-byte range from A
    with grave to y with diaeresis. White space begins and ends the text.
    """
    raw, kinds = np.frombuffer(text, np.uint8), np.frombuffer(text.translate(_KINDS), np.uint8)
    signs = np.flatnonzero(kinds == _SIGN)
    begins = np.diff(signs, prepend=-2) > 1
    first, last = signs[begins], signs[np.append(begins[1:], True)[: len(signs)]]
    first = first[kinds[last + 1] == _SPACE]
    first = first[first > 1]
    two, one = raw[first - 2], raw[first - 1]
    accented = (two == 0xC3) & (one >= 0x80) & (one <= 0xBF) & (one != 0x97) & (one != 0xB7)
    first = first[(kinds[first - 1] == _LETTER) | accented]
    return np.insert(raw, first, 32).tobytes()


def different_chunks(text: bytes) -> tuple[list[int | bytes], np.ndarray]:
    """The different chunks of a text, and for each chunk in order the number of its different one.

    A chunk goes to the space after it, inclusive; the text ends with one. Chunks of up to
    eight bytes are told apart as little-endian numbers, in which the space is the highest byte.
    """
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1
    sizes = np.diff(ends, prepend=0)
    short = sizes <= 8
    eight = np.ndarray(len(text), "<u8", text + bytes(8), strides=(1,))
    numbers = eight[(ends - sizes)[short]] & _LOW_BYTES[sizes[short]]
    few = pa.array(numbers).dictionary_encode()
    offsets = pa.py_buffer(np.append(0, ends))
    whole = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(text)])
    many = whole.filter(pa.array(~short)).dictionary_encode()
    which = np.empty(len(ends), np.int64)
    which[short] = few.indices.to_numpy()
    which[~short] = many.indices.to_numpy() + len(few.dictionary)
    return few.dictionary.to_numpy().tolist() + many.dictionary.to_numpy(zero_copy_only=False).tolist(), which


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _bytes(chunk: int | bytes) -> bytes:
    """A chunk of ``different_chunks`` as it stands in the text, without its space."""
    return (chunk.to_bytes(8, "little").rstrip(b"\0") if isinstance(chunk, int) else chunk)[:-1]


class ChunkEncoder:
    """Encodes texts by looking up their white-space separated chunks.

    The tokenizer drops white space and never joins what it separates, nor a word and the
    signs after it, so a text's ids are the ids of its chunks. The different chunks of
    many texts are looked up together, and each new one is encoded once: lower-case words
    by the tokenizer's model alone, in the form its byte-level step gives them.
    """

    def __init__(self, path: str):
        # one word at a time: threads of the library's own would only get in Spark's way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers as pre

        self.tokenizer, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model = plain.model
        self.model._resize_cache(0)  # no word comes twice
        # what the byte-level step writes for each byte, spaces apart
        byte_level = pre.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = np.arange(256, dtype="<u4")
        for char in map(chr, range(0xA1, 0x250)):
            self.spelling[list(char.encode())] = list(map(ord, byte_level.pre_tokenize_str(char)[0][0]))
        self.n_ids = max(self.tokenizer.get_vocab().values()) + 1
        self._forget()

    def _forget(self) -> None:
        # the chunk that ends a document, and what is before the first space
        self.chunks: dict[int | bytes, int] = {int.from_bytes(_STOP + b" ", "little"): 0, 32: 1}
        self.ids, self.starts, self.sizes = np.array([_END]), np.zeros(2, np.int64), np.array([1, 0])

    def encode(self, texts: list[str | bytes | None]) -> np.ndarray:
        """The ids of all texts in one array, ``_END`` after each text."""
        if len(self.chunks) > _CACHE_CHUNKS:
            self._forget()
        raws = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t or b"" for t in texts]
        whole = b"\n" + b"\n\xff\n".join([*raws, b""])
        special = [i for i, raw in enumerate(raws) if b"<|" in raw] if b"<|" in whole else []
        if special:
            kept = [raws[i] for i in special]
            for i in special:
                raws[i] = b""
            whole = b"\n" + b"\n\xff\n".join([*raws, b""])
        marked = cut_signs(whole.translate(_FOLDED))
        if special:  # a special token is looked for before anything is lower-cased, and stays whole
            parts = marked.split(_STOP)
            for i, raw in zip(special, kept):
                parts[i] = b" ".join([b"", *(w if b"<|" in w else w.lower() for w in raw.split()), b""])
            marked = _STOP.join(parts)
        different, which = different_chunks(marked)
        known = np.fromiter(map(self.chunks.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.chunks), len(self.chunks) + len(new))
            chunks = [different[i] for i in new.tolist()]
            self.chunks.update(zip(chunks, known[new].tolist()))
            self._learn(list(map(_bytes, chunks)))
        code = known[which]
        if np.count_nonzero(code == 0) != len(texts):
            raise ValueError("a text is not UTF-8")
        return gather(self.ids, self.starts[code], self.sizes[code])

    def _learn(self, chunks: list[bytes]) -> None:
        ids: list[int] = []
        ends: list[int] = []
        joined = b" ".join(chunks).decode("utf-8", "surrogatepass")
        raw = np.frombuffer(joined.lower().encode("utf-8", "surrogatepass"), np.uint8)
        spelled = self.spelling[raw].tobytes().decode("utf-32-le").split(" ")
        model, get_id = self.model.tokenize, attrgetter("id")
        for text, word in zip(joined.split(" "), spelled):
            if text.isalpha() and _near(text):
                ids.extend(map(get_id, model(word)))
            else:
                ids += self.tokenizer.encode(text, add_special_tokens=False).ids
            ends.append(len(ids))
        flat, sizes = np.array(ids, np.uint32), np.diff(ends, prepend=0)
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, flat])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])


#: Letters up to U+024F, of which normalising and lower-casing leave one word (but for I with a dot).
_near = re.compile("[\0-\u012f\u0131-\u024f]*").fullmatch


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    some = sizes > 0
    if not some.all():
        starts, sizes = starts[some], sizes[some]
    if not len(sizes):
        return flat[:0]
    ends = np.cumsum(sizes)
    # from one place to the next: one on, but to the next start where a stretch begins
    at = np.ones(ends[-1], np.int64)
    at[0] = starts[0]
    at[ends[:-1]] = starts[1:] - starts[:-1] - sizes[:-1] + 1
    return flat[np.cumsum(at, out=at)]


def re_pair(symbols: np.ndarray, first_rule: int, min_pairs: int = MIN_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Shortened symbols and the rules, an array of pairs. ``_END`` is never part of a pair.

    A round replaces all pairs at least a ``STEP``-th as frequent as the most frequent one.
    Pairs are counted exactly, and numbered once: a replacement changes only the pairs beside
    it, which leave their counts, and those that take their place hold a new symbol. A pair of
    old symbols never gets more frequent, so one that is rarer than ``min_pairs`` needs no number.
    Symbols keep their places until the end and know the places beside them. Once few places
    hold a frequent pair, these are listed.
    """
    rules: list[np.ndarray] = []
    n_rules, n = 0, len(symbols)
    # the end put after the last symbol is before the first one as well, at place -1
    symbols = np.append(symbols, _END)
    after, before, stay = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32), np.ones(n, bool)
    pairs, counts = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    # number of the pair that starts there, 0 for a rare one or none
    pair_of = np.zeros(n + 1, np.int32)
    live: np.ndarray | None = None
    at, left, right = np.arange(n), symbols[:-1], symbols[1:]
    while True:
        # an end is sorted as the symbol after the last one
        end = first_rule + n_rules
        places, new, found = _sorted_pairs(np.minimum(left, np.uint32(end)), np.minimum(right, np.uint32(end)), end + 1, at)
        enough = (found >= min_pairs) & (new >> np.uint64(32) < end) & (new & np.uint64(0xFFFFFFFF) < end)
        places = places[np.repeat(enough, found)]
        new, found = new[enough], found[enough]
        pair_of[places] = np.repeat(np.arange(len(pairs), len(pairs) + len(new)), found)
        pairs, counts = np.concatenate([pairs, new]), np.concatenate([counts, found])

        top = int(counts.max())
        if top < min_pairs:
            break
        frequent = counts >= max(min_pairs, top // STEP)
        if live is not None:
            live = np.sort(np.concatenate([live, places]))
        elif counts[counts >= min_pairs].sum() < n // 8:
            live = np.flatnonzero((counts >= min_pairs)[pair_of])
        if live is None:  # no number is out of range, and "clip" spares a copy
            at = np.flatnonzero(np.take(frequent, pair_of, mode="clip"))
        else:
            at = live[frequent[pair_of[live]]]
        # of overlapping pairs every second one, from the left
        index = np.arange(len(at))
        run_start = np.append(True, after[at[:-1]] != at[1:])
        first = np.maximum.accumulate(np.where(run_start, index, 0))
        at = at[(index - first) & 1 == 0]
        number = pair_of[at]
        used = np.zeros(len(pairs), bool)
        used[number] = True
        rules.append(np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        made = (first_rule + n_rules - 1 + np.cumsum(used)).astype(np.uint32)[number]
        symbols[at] = made
        n_rules += len(rules[-1])
        # the pairs that are replaced, those after them, and those before that are neither
        second, one_before = after[at], before[at]
        apart = np.append(True, second[:-1] != one_before[1:])
        apart[0] = one_before[0] >= 0
        one_before = one_before[apart]
        for gone in (second, one_before):
            counts -= np.bincount(pair_of[gone], minlength=len(pairs))
            pair_of[gone] = 0
        pair_of[at] = 0
        counts[frequent] = counts[0] = 0
        stay[second] = False
        third = after[second]
        after[at], before[third] = third, at
        # the pairs that start at the new symbols and before them, each once
        at = np.concatenate([at, one_before])
        left, right = np.concatenate([made, symbols[one_before]]), np.concatenate([symbols[third], made[apart]])
        # a pair is no more frequent than all that share its slot; most are rare and need no sorting
        slot = ((left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA6B)) >> np.uint32(14)).astype(np.intp)
        enough = np.take(np.bincount(slot, minlength=1 << 18) >= min_pairs, slot, mode="clip")
        at, left, right = at[enough], left[enough], right[enough]
        if live is not None:
            live = live[pair_of[live] > 0]
    return symbols[:-1][stay], np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)


def _sorted_pairs(
    left: np.ndarray, right: np.ndarray, above: int, places: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places (by default the order) as they sort the pairs, each different pair and how often it is there.

    Symbols are less than ``above``.
    """
    places = np.arange(len(left)) if places is None else places
    width, bits = above.bit_length(), int(places.max(initial=0)).bit_length()
    if 2 * width + bits <= 64:  # sorting numbers is several times faster than sorting indices
        key = left.astype(np.uint64)
        key <<= np.uint64(width)
        key |= right
        key <<= np.uint64(bits)
        key |= places.view(np.uint64)
        key.sort()
        places = (key & np.uint64((1 << bits) - 1)).view(np.int64)
        key >>= np.uint64(bits)
    else:
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        order = np.argsort(key)
        key, places, width = key[order], places[order], 32
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    pairs = key[starts]
    pairs = ((pairs >> np.uint64(width)) << np.uint64(32)) | (pairs & np.uint64((1 << width) - 1))
    return places, pairs, np.diff(np.append(starts, len(key)))


def expand_rules(rules: np.ndarray, first_rule: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All expansions one after the other, and where each starts."""
    starts = np.cumsum(lengths.astype(np.int64)) - lengths
    flat = np.empty(int(lengths.sum(dtype=np.int64)), np.uint32)
    for r, (a, b) in enumerate(rules.tolist()):
        at = starts[r]
        for s in (a, b):
            if s < first_rule:
                flat[at] = s
                at += 1
            else:
                i = s - first_rule
                flat[at : at + lengths[i]] = flat[starts[i] : starts[i] + lengths[i]]
                at += lengths[i]
    return flat, starts


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((1 if a < first_rule else out[a - first_rule]) + (1 if b < first_rule else out[b - first_rule]))
    return np.array(out, np.uint32)


def pack24(x: np.ndarray) -> bytes:
    wide, out = x.astype("<u4").view(np.uint8).reshape(-1, 4), np.empty((len(x), 3), np.uint8)
    for i in range(3):  # a column at a time is several times faster than rows of three bytes
        out[:, i] = wide[:, i]
    return out.tobytes()


def unpack24(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return wide.reshape(-1).view("<u4")


def make_shard(number: int, ids: list, stream: np.ndarray, first_rule: int, end_id: int) -> dict:
    """A shard from the documents' ids, ``_END`` after each document."""
    symbols, rules = re_pair(stream, first_rule)
    symbols = symbols.copy()
    ends = np.flatnonzero(symbols == _END)
    symbols[ends] = end_id
    if first_rule + len(rules) >= 1 << 24:
        raise ValueError("a shard has more rules than 24-bit symbols can name")
    return {
        "shard": number,
        "doc_ids": ids,
        "doc_tokens": np.diff(np.flatnonzero(stream == _END), prepend=-1).tolist(),
        "doc_symbols": np.diff(ends, prepend=-1).tolist(),
        "n_tokens": len(stream),
        "first_rule": first_rule,
        "end_id": end_id,
        "rules": rules.astype("<u4").tobytes(),
        "lengths": rule_lengths(rules, first_rule).astype("<u4").tobytes(),
        "symbols": pack24(symbols),
    }


class Shard:
    """Reads one row of the table."""

    def __init__(self, row: dict):
        self.first, self.end_id = row["first_rule"], row["end_id"]
        rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        self.flat, starts = expand_rules(rules, self.first, lengths)
        self.table = np.concatenate([np.arange(self.first, dtype=np.uint32), self.flat])
        self.starts = np.concatenate([np.arange(self.first), self.first + starts])
        self.sizes = np.concatenate([np.ones(self.first, np.int64), lengths])
        self.symbols = unpack24(row["symbols"])
        self.doc_ids = row["doc_ids"]
        self.ends = np.cumsum(row["doc_symbols"])

    def document(self, i: int) -> np.ndarray:
        """All ids of the i-th document, with its end id; no other document is touched."""
        s = self.symbols[self.ends[i - 1] if i else 0 : self.ends[i]]
        return gather(self.table, self.starts[s], self.sizes[s])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents one after the other, and where each ends."""
        sizes = self.sizes[self.symbols]
        return gather(self.table, self.starts[self.symbols], sizes), np.append(0, np.cumsum(sizes))[self.ends]

    def ids_between(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of a document: lengths alone find the symbols that hold them."""
        s = self.symbols[self.ends[i - 1] if i else 0 : self.ends[i]]
        until = np.cumsum(self.sizes[s])
        low, high = np.searchsorted(until, start, "right"), np.searchsorted(until, stop, "left") + 1
        skipped = until[low - 1] if low else 0
        part = s[low:high]
        return gather(self.table, self.starts[part], self.sizes[part])[start - skipped : stop - skipped]


_encoders: dict[str, ChunkEncoder] = {}


def by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TEXT_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    step = (np.cumsum(sizes, dtype=np.int64) - sizes) // TEXT_BYTES
    cuts = [*np.flatnonzero(np.diff(step, prepend=-1)).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        yield batch.slice(start, stop - start)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2) -> None:
    """Encode ``docs`` and write the shards to ``path``. ``tokenizer``: a file on every executor."""
    ordered = (
        docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
        .repartitionByRange(F.col("id").asc_nulls_last())
        .sortWithinPartitions(F.col("id").asc_nulls_last())
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = ChunkEncoder(tokenizer)
        encoder = _encoders[tokenizer]
        first_rule = encoder.n_ids
        number, ids, streams, size = 0, [], [], 0

        def shard() -> pa.RecordBatch:
            made = make_shard(number, ids, np.concatenate(streams), first_rule, end_id)
            return pa.RecordBatch.from_pylist([made], SHARD_ARROW)

        for batch in batches:
            for part in by_bytes(batch):  # documents are never cut, shards end between them
                ids += part.column("id").to_pylist()
                streams.append(encoder.encode(part.column("text").cast(pa.binary()).to_pylist()))
                size += len(streams[-1])
                if size >= SHARD_IDS:
                    yield shard()
                    number, ids, streams, size = number + 1, [], [], 0
        if ids:
            yield shard()

    shards = ordered.mapInArrow(encode, SHARD_SCHEMA)
    shards.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(path)


SHARD_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())),
        ("doc_symbols", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("first_rule", pa.int32()),
        ("end_id", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()),
    ]
)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            shard = Shard(row)
            ids, ends = shard.all()
            n, sizes, data = len(ends), np.diff(ends, prepend=0), memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * (end - size) : 4 * end]) for end, size in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                ],
                ["part", "shard", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, decoded from its symbols.

    Starts come from three levels: documents in a shard, shards in a partition, partitions;
    only the last, one row per partition, is summed in one place.
    """
    table = spark.read.parquet(path)
    decoded = table.mapInArrow(
        _decode, "part int, shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    shards = table.select("part", "shard", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    part_start = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("p"))
    shard_start = F.sum("n_tokens").over(W.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    starts = shards.withColumn("s", shard_start).join(part_start, "part").select("part", "shard", (F.col("p") + F.col("s")).alias("before"))
    return decoded.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )
