"""BPE encoding by dynamic programming over prefixes, and decoding.

A word is a string of the vocabulary's smallest pieces (the last one ends the word). Byte pair
encoding has this property: of all tokens that end at some place of a word, exactly one is
the last token of the encoding of the prefix up to there, and it is the one that goes with the
last token of the shorter prefix it follows. Two tokens go together if encoding their joined
text gives these two again.

So a word is read once. A suffix automaton of the vocabulary names the tokens that end at each
place; the pair test picks the one that is kept there; from the word's end the kept tokens
lead back to its beginning. No pair is ever merged, and the time is proportional to the
word's length times the tokens that end at a place, for words of any length.

The pair test goes down the inner edges of both tokens. A token's edge changes when it is
built: while merges run in order of rank, the piece at the edge is there from the rank that
makes it up to the rank that uses it. The tokens do not go together exactly if two edge pieces
that are there at the same time have a merge that comes while both are there.

Texts are cut as the tokenizer does: special tokens in their exact form first, then its own
normalisation and word pattern. The chunks between white space are looked up once and
remembered; a remembered chunk's ids are those that the dynamic programming gave.

Decoding looks the ids up and joins the pieces with a space, as a tokenizer file without a
decoder does; unknown ids are left out.

Defined cases: a null or empty text has no ids and decodes to the empty text; a chunk without
a word has none either; columns that are not asked for are left alone, whatever their names;
repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Remembered chunks, words and token pairs a process: some 200 MB.
_CACHE_SIZE, _CACHE_LETTERS, _CACHE_PAIRS = 400_000, 64, 2_000_000
_NEVER = 1 << 40


class PrefixBpe:
    """Encodes and decodes with a tokenizer file that holds a BPE model with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.special = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.end or model["dropout"] or model["ignore_merges"] or spec["decoder"]:
            raise ValueError("not a BPE file with word ends and plain decoding")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens must be plain")
        self.library = Tokenizer.from_file(path)  # for its normaliser and word pattern alone
        self.pieces: dict[int, str] = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self._edges(model["vocab"], model["merges"])
        self._automaton(model["vocab"])
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.together: dict[tuple[int, int], bool] = {}
        self.chunks: dict[str, list[int]] = {}
        self.words: dict[str, list[int]] = {}

    def _edges(self, vocab: dict[str, int], merges: list) -> None:
        """rank: of the merge of two tokens. made: of the merge that makes a token, with its halves."""
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for at, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = vocab[left], vocab[right]
            made = vocab[left + right]
            if (a, b) in self.rank or made in self.made:
                raise ValueError("a merge is listed twice")
            self.rank[a, b], self.made[made] = at, (at, a, b)
        if any(self.made.get(half, (-1,))[0] > at for pair, at in self.rank.items() for half in pair):
            raise ValueError("a merge comes before its halves")

    def _automaton(self, vocab: dict[str, int]) -> None:
        """Finds the tokens that end at a place. A last piece is one letter, in a range of its own."""
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            spelled = self.spell(token[: -len(self.end)]) if token.endswith(self.end) else token
            if i not in self.made and len(spelled) > 1:
                continue  # neither a single piece nor made by a merge: encoding never gives it
            if i not in self.made or self.goes(*self.made[i][1:], self.made[i][0]):
                self.automaton.add_word(spelled, (i, len(spelled)))
        self.automaton.make_automaton()

    @staticmethod
    def spell(word: str) -> str:
        """The word's letters, the last one moved to the range of last pieces."""
        return word[:-1] + chr(ord(word[-1]) + 0x10000) if word else chr(0x1FFFF)

    def goes(self, a: int, b: int, limit: int = _NEVER) -> bool:
        """Whether no merge of a rank below ``limit`` crosses the border between the tokens."""
        until_a = until_b = limit
        while True:
            at = self.rank.get((a, b))
            # of equal pairs the left one is merged first: a's own use of its edge wins a tie, b's doesn't
            if at is not None and at < until_a and (at < until_b or (at == until_b < limit)):
                return False
            made_a, made_b = self.made.get(a), self.made.get(b)
            if made_a is None and made_b is None:
                return True
            # the younger of the two is not there before its merge: go back to what it was made of
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                until_a, _, a = made_a
            elif made_a is None or made_b[0] > made_a[0]:
                until_b, b, _ = made_b
            else:  # the same token on both sides: the two are made at the same rank, the left one first
                until_b, b, _ = made_b

    def word(self, spelled: str) -> list[int]:
        """The ids of one word given by its letters (see spell)."""
        last, size = [-1] * (len(spelled) + 1), [0] * (len(spelled) + 1)
        together = self.together
        if len(together) > _CACHE_PAIRS:
            together.clear()
        for at, (token, length) in self.automaton.iter(spelled):
            if last[at + 1] >= 0:
                continue
            start = at + 1 - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = together.get((before, token))
                if fits is None:
                    fits = together[before, token] = self.goes(before, token)
                if not fits:
                    continue
            last[at + 1], size[at + 1] = token, length
        if last[-1] < 0:
            raise ValueError("the vocabulary lacks a single piece")
        out, at = [], len(spelled)
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def _words(self, chunk: str) -> list[str]:
        """The chunk's words as the tokenizer cuts them, in letters for bytes."""
        if chunk.isascii() and chunk.isprintable():  # such bytes stand for themselves
            return _ASCII_WORD.findall(chunk.lower())
        # the library's normaliser, pattern and byte letters see the whole chunk
        normal = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def chunk(self, chunk: str) -> list[int]:
        """The ids of what lies between two white spaces and holds no special token."""
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = []
            for w in self._words(chunk):
                found = self.words.get(w)
                if found is None:
                    found = _remember(self.words, w, self.word(self.spell(w)))
                ids += found
            _remember(self.chunks, chunk, ids)
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        extend, known, learn = out.extend, self.chunks, self.chunk
        pieces = [text or ""]
        if self.special_pattern and "<|" in pieces[0]:
            pieces = self.special_pattern.split(pieces[0])
        for n, piece in enumerate(pieces):
            if n % 2:
                out.append(self.special[piece])
                continue
            for c in _SPACE.split(piece):
                if c:
                    extend(known[c] if c in known else learn(c))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        pieces = self.pieces
        return " ".join([pieces[i] for i in ids if i in pieces])


# White space of ASCII; what else the tokenizer takes for white space stays inside a chunk.
_SPACE = re.compile("[ \t\n\x0b\x0c\r]+")
# The word pattern of such vocabularies, for lower-case ASCII without white space.
_ASCII_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def _remember(cache: dict[str, list[int]], key: str, ids: list[int]) -> list[int]:
    if len(key) <= _CACHE_LETTERS:
        if len(cache) >= _CACHE_SIZE:
            cache.clear()
        cache[key] = ids
    return ids


_models: dict[str, PrefixBpe] = {}


def model(path: str) -> PrefixBpe:
    """The model of a file, made once in a process."""
    if path not in _models:
        _models[path] = PrefixBpe(path)
    return _models[path]


def _encode_all(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.array(bpe.encode(t), "<u4") for t in part.column("text").to_pylist()]
                out = [part.column("row"), pa.array(list(map(len, ids)), pa.int64()), pa.array([i.tobytes() for i in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(out, ["row", "n_tokens", "ids"])

    return run


def _decode_all(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [None if i is None else bpe.decode(np.frombuffer(i, "<u4").tolist()) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return run


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """row (the columns ``keep``), n_tokens, ids (little-endian unsigned 32-bit). path: a file on every executor."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_encode_all(path), f"row {_kind(rows, 'row')}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """What ``encode`` gives, with the text that the ids stand for as decoded; null ids give null."""
    rows = encoded.select("row", "n_tokens", "ids")
    return rows.mapInArrow(_decode_all(path), f"row {_kind(rows, 'row')}, n_tokens bigint, ids binary, decoded string")
