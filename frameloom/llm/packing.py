"""Packing tokenised documents into sequences by vector bin packing."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.util import TEXT_ROWS, table, text_of, tidy

#: Tokens and documents that are packed at a time within a task: the memory bound of the operator.
WINDOW_TOKENS, WINDOW_DOCUMENTS = 1 << 20, 4096
#: Words whose ids a worker remembers, and the longest such word; only speed depends on them.
CACHED_WORDS, CACHED_LENGTH = 300_000, 48


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"]


#: A word that needs no look at its neighbours: Latin letters of one code point each, then ASCII punctuation but the apostrophe.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte: its own if it has one, else the next from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def word_tokenizer(path: str, end_id: int | None = 1, cached_words: int = CACHED_WORDS) -> Callable[[str], bytes]:
    """A function from a text to its token ids as little-endian unsigned 32-bit integers, end_id last, for vocabularies of the kind below.

    The vocabulary (BPE with word ends over lower case) drops white space and never merges across it, so a text's
    ids are those of its space-separated words in turn. Frequent words are remembered; a new plain word
    goes to the merges directly and any other through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    encoder, known, stems, letters = Tokenizer.from_file(path), {}, {}, byte_letters()
    merges, tail = encoder.model, b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def whole(word: str) -> bytes:
        return np.array(encoder.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def one(word: str) -> bytes:
        if len(word) > CACHED_LENGTH or not (plain := _PLAIN.fullmatch(word)):
            return whole(word)
        stem, after = plain[1].lower(), plain[2]
        if (ids := stems.get(stem)) is None:
            spelt = stem if stem.isascii() else stem.encode().decode("latin-1").translate(letters)
            if len(stems) >= cached_words:
                stems.clear()
            ids = stems[stem] = struct.pack(f"<{len(found := [t.id for t in merges.tokenize(spelt)])}I", *found)
        if not after:
            return ids
        if (mark := known.get(after)) is None:
            mark = known[after] = whole(after)
        return ids + mark

    def encode(text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        parts = list(map(known.get, words))
        if None in parts:
            if len(known) >= cached_words:
                known.clear()
            for i, part in enumerate(parts):
                if part is None:
                    parts[i] = code = one(words[i])
                    if len(words[i]) <= CACHED_LENGTH:
                        known[words[i]] = code
        return b"".join(parts) + tail

    return encode


def pack_window(sizes: np.ndarray, losses: np.ndarray, limits: tuple[int, int, int]) -> Iterator[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) for items of sizes[i] tokens, the last losses[i] of them loss-bearing.

    Each bin starts from the largest rest and takes, again and again, the piece with the largest dot product of
    its demand (tokens, one segment, loss-bearing tokens) and the room left, both as shares of the limits, of
    those that fit whole. When none fits, the piece of the best dot product is cut to fill what is left.
    What remains at the end fills bins of powers of two, which need no padding.
    """
    cap, segments, loss_cap = limits
    live = np.flatnonzero(sizes > 0)
    live = live[np.argsort(-sizes[live], kind="stable")]
    left, loss, at = sizes[live].astype(np.int64), losses[live].astype(np.int64), np.zeros(len(live), np.int64)
    rest, gone = int(left.sum()), 0
    while rest:
        target = cap if rest >= cap else 1 << (rest.bit_length() - 1)
        room, room_seg, room_loss, out = target, segments, loss_cap, []
        while room and room_seg and gone < len(live):
            score = left * (room / cap**2) + loss * (room_loss / loss_cap**2)  # each piece is one segment, so that term is the same for all
            fits = np.where((left > 0) & (left <= room) & (loss <= room_loss), score, -1.0)
            k = int(fits.argmax())
            if fits[k] < 0:
                k = int(np.where(left > 0, score, -1.0).argmax())
            n = int(min(left[k], room, left[k] - loss[k] + room_loss))
            if not n:
                break
            out.append((int(live[k]), int(at[k]), n))
            used = max(0, n - int(left[k] - loss[k]))
            at[k], left[k], loss[k] = at[k] + n, left[k] - n, loss[k] - used
            room, room_seg, room_loss, rest = room - n, room_seg - 1, room_loss - used, rest - n
            if not left[k]:
                gone += 1
                if 2 * gone > len(live):  # leave out those that are packed
                    still = left > 0
                    live, left, loss, at, gone = live[still], left[still], loss[still], at[still], 0
        yield out


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
    max_tokens: int = 2048, max_segments: int = 256, max_loss_tokens: int = 2048, end_id: int | None = 1,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """Pieces of the rows' token sequences, placed in sequences of at most max_tokens tokens, max_segments
    pieces and max_loss_tokens loss-bearing tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens, ids (the piece's own ids).

    prompt_col: how many of a row's first ids bear no loss (none if not given; null: none; more than
    there are: all). Each input partition is packed where it is read, in windows of WINDOW_TOKENS, so
    there is no shuffle, no hot group and no unbounded state; a task that is run again packs its rows alike.
    A row longer than a window is a window of its own. Of pieces with equal scores the longer document goes first, of equally long ones the earlier. A null or empty text has only end_id (or no piece, if
    end_id is None). cached_words bounds what a worker remembers; no result depends on it. Repeated rows are packed as often as they occur; an empty table gives none. Other
    columns are not read.
    """
    if min(max_tokens, max_segments, max_loss_tokens) < 1:
        raise ValueError("the limits must be at least 1")
    prompt = F.lit(0) if prompt_col is None else F.coalesce(df[f"`{prompt_col}`"].cast("int"), F.lit(0))
    rows = df.select(df[f"`{id_col}`"].alias("doc_id"), text_of(df[f"`{text_col}`"]).alias("text"), prompt.alias("prompt"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    limits = (max_tokens, max_segments, max_loss_tokens)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number, held = word_tokenizer(tokenizer_path, end_id, cached_words), TaskContext.get().partitionId() << 36, []

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            sizes = np.array([len(code) // 4 for _, code, _ in held], np.int64)
            losses = sizes - np.clip(np.array([skip for *_, skip in held], np.int64), 0, sizes)
            found = []
            for bin_ in pack_window(sizes, losses, limits):
                offset = 0
                for i, start, length in bin_:
                    piece = held[i][1][4 * start : 4 * (start + length)]
                    plain = max(0, int(sizes[i] - losses[i]) - start)
                    found.append((held[i][0], start, length, zlib.crc32(piece), int(sizes[i]), number, offset, max(0, length - plain), piece))
                    offset += length
                number += 1
            held.clear()
            columns = list(zip(*found, strict=True)) or [[]] * 9
            types = [id_type, *[pa.int64()] * 7, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=PIECE)

        tokens, id_type = 0, None
        for batch in (b.slice(at, TEXT_ROWS) for b in batches for at in range(0, b.num_rows, TEXT_ROWS)):
            id_type = batch.column(0).type
            for row_id, text, skip in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                code = encode(text)
                if held and (tokens + len(code) // 4 > WINDOW_TOKENS or len(held) >= WINDOW_DOCUMENTS):
                    yield flush(id_type)
                    tokens = 0
                held.append((row_id, code, skip))
                tokens += len(code) // 4
        if held:
            yield flush(id_type)

    return rows.mapInArrow(tidy(packed), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_file()).drop("ids", "loss_tokens")
