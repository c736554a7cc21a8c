"""Byte-level BPE: texts to token ids by an index of pair occurrences, and ids back to texts."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.packing import byte_letters
from frameloom.llm.util import table, text_of

#: Fixed value: how byte-level BPE of this family cuts a text into pieces; merges never cross them.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of texts that are cut at a time, pieces of one text that are held at a time, and bytes of new pieces that one index holds (a longer
#: piece has an index of its own). None changes a result.
BLOCK_CHARS, BLOCK_PIECES, INDEX_BYTES = 1 << 20, 200_000, 1 << 21
#: Pieces whose ids a worker remembers, and the longest such piece.
KNOWN_PIECES, KNOWN_LENGTH = 400_000, 64

_END, _GONE = -1, -2


class Vocabulary:
    """A byte-level BPE vocabulary in the file format of the tokenizers library: its merges by pair, its ids' bytes and its added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, cutter = told["model"], told["pre_tokenizer"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in plain) or told["normalizer"] or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        ids, letters = model["vocab"], byte_letters()
        byte_of = {ord(c): b for b, c in letters.items()}
        self.first = [ids[letters[b]] for b in range(256)]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left, right, made) by rank; the rank by left * width + right.
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.width = 1 + max([*ids.values(), *(t["id"] for t in told["added_tokens"])])
        self.rank = {a * self.width + b: r for r, (a, b, _) in reversed(list(enumerate(self.merges)))}
        if len({m for *_, m in self.merges}) < len(self.merges):
            raise ValueError(f"{path} makes a token by two merges")  # else every pair of a new token has a greater rank than the token
        self.bytes = [b""] * self.width
        for token, i in ids.items():
            self.bytes[i] = bytes(byte_of[ord(c)] for c in token)
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
            raise ValueError(f"{path} has added tokens that look at their neighbours")
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut_added = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})").split if self.added else lambda text: [text]

    def merged(self, pieces: list[bytes]) -> list[array]:
        """The ids of each piece (not empty), all merged together.

        The pieces' symbols lie end to end. An index has, for each pair that a merge is for, all places of its left symbol. The
        least rank of those in the index is taken next; its places are merged in order, the pairs that a merge undoes are
        left out when their own turn comes, and the pairs that it makes join the lists of their ranks. A token is made by one merge only, so
        a new pair's rank is greater than the present one, and each piece sees its merges in the order in which it alone would: by rank, then by place.
        """
        width, rank_of, merges = self.width, self.rank, self.merges
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes + 1)
        start = np.full(int(ends[-1]), _END, np.int32)
        inside = np.ones(len(start), bool)
        inside[ends - 1] = False
        start[inside] = np.array(self.first, np.int32)[np.frombuffer(b"".join(pieces), np.uint8)]
        code = start[:-1].astype(np.int64) * width + start[1:]
        code[~(inside[:-1] & inside[1:])] = -1
        order = np.argsort(code, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(code[order]) != 0)) if len(code) else np.zeros(0, int)
        index: dict[int, array] = {}
        for at, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(code)], strict=True):
            r = rank_of.get(int(code[order[at]]))
            if r is not None:
                index[r] = array("i", order[at:stop].astype(np.int32).tobytes())
        symbol = array("i", start.tobytes())
        after = array("i", np.arange(1, len(start) + 1, dtype=np.int32).tobytes())
        before = array("i", np.arange(-1, len(start) - 1, dtype=np.int32).tobytes())
        active = list(index)
        heapify(active)
        while active:
            r = heappop(active)
            left, right, made = merges[r]
            for i in sorted(index.pop(r)):
                j = after[i]
                if symbol[i] != left or symbol[j] != right:
                    continue  # an earlier merge took one of them
                symbol[i], symbol[j], k, h = made, _GONE, after[j], before[i]
                after[i], before[k] = k, i  # a piece's end stands after its last symbol, so there is always a k
                if h >= 0 and symbol[h] >= 0 and (new := rank_of.get(symbol[h] * width + made)) is not None:
                    if new not in index:
                        index[new] = array("i")
                        heappush(active, new)
                    index[new].append(h)
                if symbol[k] >= 0 and (new := rank_of.get(made * width + symbol[k])) is not None:
                    if new not in index:
                        index[new] = array("i")
                        heappush(active, new)
                    index[new].append(i)
        symbols = np.frombuffer(symbol, np.int32)
        kept = symbols >= 0
        stops = np.cumsum(kept)[ends - 1].tolist()
        ids = array("i", symbols[kept].tobytes())
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """A file's vocabulary, read once in each worker."""
    return Vocabulary(path)


def _cut(texts: Iterable[str], vocabulary: Vocabulary) -> Iterator[list[str | int]]:
    """The pieces of texts in turn, an added token as its id, in lists of BLOCK_PIECES at most."""
    pattern = regex.compile(PIECE)
    for text in texts:
        for part in vocabulary.cut_added(text):
            if part in vocabulary.added:
                yield [vocabulary.added[part]]
            elif len(part) <= BLOCK_PIECES:
                yield pattern.findall(part)
            else:
                found = (m[0] for m in pattern.finditer(part))
                while block := list(islice(found, BLOCK_PIECES)):
                    yield block


def encoder(vocabulary: Vocabulary):
    """A function from a list of texts to each one's ids, as little-endian unsigned 32-bit integers. It remembers pieces between calls."""
    known: dict[str | int, bytes] = {}

    def look_up(lists: list[list[str | int]]) -> list[bytes]:
        """The ids of each list of pieces. Pieces that aren't known are merged together, in indexes of INDEX_BYTES."""
        if len(known) > KNOWN_PIECES:
            known.clear()
        new = list(dict.fromkeys(p for x in lists for p in x if p not in known))
        held, raw, size = [], [], 0
        for k, p in enumerate(new):
            if isinstance(p, int):
                known[p] = np.array([p], "<u4").tobytes()
            else:
                held.append(p)
                raw.append(p.encode("utf-8", "surrogatepass"))
                size += len(raw[-1])
            if held and (size >= INDEX_BYTES or k == len(new) - 1):
                for q, ids in zip(held, vocabulary.merged(raw), strict=True):
                    known[q] = np.array(ids, "<u4").tobytes()
                held, raw, size = [], [], 0
        out = [b"".join(map(known.__getitem__, x)) for x in lists]
        for q in new:
            if not isinstance(q, int) and len(q) > KNOWN_LENGTH:
                del known[q]
        return out

    def encode(texts: list[str]) -> list[bytes]:
        short = [t for t in texts if len(t) <= BLOCK_PIECES and not any(a in t for a in vocabulary.added)]
        if len(short) == len(texts):
            return look_up([next(_cut([t], vocabulary), []) for t in texts])
        return [b"".join(look_up([pieces])[0] for pieces in _cut([t], vocabulary)) for t in texts]

    return encode


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lists of about BLOCK_CHARS."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def encode_texts(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and ids (little-endian unsigned 32-bit integers) of each row's whole text, without special tokens added.

    An added token of the vocabulary that stands in a text gets its own id, as the vocabulary's library does. A null text counts as empty: no ids. Rows
    are encoded where they are read, so there is no shuffle and no hot group; within a partition the pieces that several texts share are merged once
    for each block that has them anew. Repeated rows and ids give repeated results, an empty table none; other columns are not read.
    """
    rows = df.select(df[f"`{id_col}`"].alias("id"), text_of(df[f"`{text_col}`"]).alias("content"))
    kind = rows.schema["id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary(vocabulary_path))
        for batch in batches:
            at = 0
            for texts in _blocks(batch.column("content").to_pylist()):
                found = encode(texts)
                own = batch.column("id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([own, pa.array([len(f) // 4 for f in found], pa.int64()), pa.array(found, pa.binary())], names=["id", "n_tokens", "ids"])

    return rows.mapInArrow(encoded, f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """df's columns and text_col, the text of each row's ids, special tokens included; it replaces a column of that name.

    Bytes that aren't UTF-8, as a cut sequence may have, become U+FFFD. Null ids give a null text, no ids an empty one; an id outside of the
    vocabulary, or bytes that aren't whole ids, raise.
    """
    names = df.columns
    rows = df.select(*(df[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(names)))
    ids_at = names.index(ids_col)
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(df.schema)) + ", decoded string"

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = vocabulary(vocabulary_path).bytes.__getitem__
        for batch in batches:
            found = [None if ids is None else b"".join(map(of, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace") for ids in batch.column(ids_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "decoded"])

    out = rows.mapInArrow(decoded, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c != text_col), F.col("decoded").alias(text_col))


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_file()
    ids = encode_texts(table(spark, sf_dir, "documents"), path)
    digests = decode_ids(ids, path, text_col="decoded")
    return digests.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
