"""Mixture-controlled packing of token sequences by deficit round-robin over source queues.

Every source is a queue of packets: documents, long ones cut to ``grain`` tokens. Each round adds a
quantum to every source's deficit (its target share of one window) and serves the packets that the
deficit covers; what is left over is carried to the next round. A packet that ends at token ``e`` of
its queue is therefore served in round ``ceil(e / quantum)``, whatever window or partition comes
before it, so no state passes between tasks: two running totals (within the queue, then over rounds)
place every token. The served stream is cut into windows of ``window`` tokens; only the last one is
not full.

Null texts are empty documents, which still carry the end token. Null sources form one queue. Rows
repeated with one doc_id are packed as often as they occur. An empty table gives no pieces. Extra
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.llm.common import handing_back, release_memory, running_total
from spendcast.session import materialize

WINDOW, GRAIN, END_ID = 2048, 512, 1

#: Runs without white space, as the tokenizer's own pattern sees it. Control characters 0x1c to 0x1f
#: are white space to Python only, so they stay inside a run.
CHUNK = re.compile(r"[\S\x1c-\x1f]+")


def _letters(kind: str) -> str:
    return re.escape("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind))


#: Runs of these characters are cut to words here, by the tokenizer's own rule; composing accents and
#: lower-casing do nothing to them that ``str.lower`` doesn't.
PLAIN = "!-~\xa1-\u012f\u0131-\u024f"
OTHER = re.compile(f"[^ {PLAIN}]")
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_letters('L')}]+|[{_letters('N')}]|[^\\s{_letters('L')}{_letters('N')}]+")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def rank_encoding(definition: dict):
    """The merges of a byte-level BPE with word ends as a rank vocabulary whose ranks are its ids, or None.

    A word ends with a zero byte, which joins the last byte before anything else. Merging by rank then
    gives the tokenizer's ids if ids rise with the merges and every token, taken by itself, merges to
    itself: two tokens that make up a third but aren't its merge cannot come to stand side by side,
    for the third by itself would have stopped there, too. Both conditions are checked here.
    """
    import tiktoken
    from tokenizers import Tokenizer

    own, suffix = definition["model"], "</w>"
    vocab, merges = own["vocab"], [m.split(" ") if isinstance(m, str) else m for m in own["merges"]]
    made = [vocab.get(a + b) for a, b in merges]
    if own["end_of_word_suffix"] != suffix or None in made or made != sorted(made) or made and made[0] < 512:
        return None
    bare = definition | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
    ending = Tokenizer.from_str(json.dumps(bare))
    inner = Tokenizer.from_str(json.dumps(bare | {"model": own | {"end_of_word_suffix": None}}))
    special, byte, ranks = {t["content"] for t in definition["added_tokens"]}, byte_characters(), {}
    for piece, number in vocab.items():
        stem = piece.removesuffix(suffix)
        if piece in special:
            continue
        if not all(c in byte for c in stem) or (inner if stem == piece else ending).encode(stem).ids != [number]:
            return None
        data = bytes(byte[c] for c in stem)
        if b"\0" not in data:
            ranks[data + (b"" if stem == piece else b"\0")] = number
    ranks[b"\0"] = max(vocab.values()) + 1
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Token ids of texts by a ``tokenizers`` file that lower-cases and drops white space between words.

    Neither its normaliser nor its pre-tokenizer joins anything across white space, so runs between
    white space are encoded once and looked up afterwards. The table is emptied at ``limit`` entries.
    """

    def __init__(self, path: str, limit: int = 400_000, long_run: int = 200):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for piece, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[number] = piece.endswith("</w>")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            self.ranks = rank_encoding(json.load(file))
        self.limit, self.long_run = limit, long_run
        self.known: dict[str, bytes] = {}
        release_memory()  # the file's text and the tokenizers that the ranks were checked by

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _encode_words(self, ended: str) -> np.ndarray:
        """Ids of words that each end with a zero character."""
        if self.ranks:
            return np.array(self.ranks.encode_ordinary(ended), self.kind)
        return self._encode(ended.replace("\0", " "))

    def _unplain(self, runs: list[str], joined: str) -> set[str]:
        """The runs (``joined`` by single spaces) that hold other characters than ``PLAIN`` or a special token."""
        found, at = set(), OTHER.search(joined)
        while at:
            begin, end = joined.rfind(" ", 0, at.start()) + 1, joined.find(" ", at.end())
            found.add(joined[begin : end if end >= 0 else None])
            at = OTHER.search(joined, end) if end >= 0 else None
        if any(x in joined for x in self.special):
            found.update(r for r in runs if any(x in r for x in self.special))
        return found

    def _learn(self, runs: list[str]) -> None:
        plain, joined = runs, " ".join(runs)
        other = self._unplain(runs, joined)
        if other:
            plain = [r for r in runs if r not in other]
            joined = " ".join(plain)
            self.known.update((run, self._encode(run).tobytes()) for run in other)
        if not plain:
            return
        # One call for all of them: every word gets an end, and the last token of every word is marked.
        marked = WORD.sub("\\g<0>\0", joined.lower())
        symbols = np.frombuffer(marked.encode("utf-8", "surrogatepass"), np.uint8)
        words = np.r_[np.searchsorted(np.flatnonzero(symbols == 0), np.flatnonzero(symbols == 32)), np.count_nonzero(symbols == 0)]
        ids = self._encode_words(marked.replace(" ", ""))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(words) != len(plain) or len(ends) != words[-1]:
            self.known.update((run, self._encode(run).tobytes()) for run in plain)
            return
        data, places = ids.tobytes(), (np.r_[0, np.r_[0, ends][words]] * self.kind.itemsize).tolist()
        self.known.update(zip(plain, map(data.__getitem__, map(slice, places, places[1:]))))

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """New runs of all texts are encoded in one go; long ones are not worth a place in the table."""
        known = self.known
        if len(known) > self.limit:
            known.clear()
        cut = [CHUNK.findall(t) if any(c in t for c in "\x1c\x1d\x1e\x1f") else t.split() for t in texts]
        missing = set().union(*cut) - known.keys()
        long = [r for r in missing if len(r) > self.long_run] if max(map(len, missing), default=0) > self.long_run else []
        self._learn(list(missing.difference(long) if long else missing))
        for run in long:
            known[run] = self._encode(run).tobytes()
        found = [b"".join(map(known.__getitem__, runs)) for runs in cut]
        for run in long:
            del known[run]
        return found

    def forget(self) -> None:
        """Empty the table, so that a worker holds nothing for the stages that it runs later."""
        self.known.clear()


#: Characters of texts whose new runs are encoded together.
TOGETHER = 4 << 20


_ENCODERS: dict[str, ChunkEncoder] = {}


def tokenize(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (row, doc_id, source, doc_tokens, ids, wide): ids are packed little-endian, end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(vocabulary) or _ENCODERS.setdefault(vocabulary, ChunkEncoder(vocabulary))
        end, row = np.array([END_ID], encoder.kind).tobytes(), TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, waiting, size = [], [], 0
            for text in batch.column(2).to_pylist():
                waiting.append(text or "")
                size += len(waiting[-1])
                if size >= TOGETHER:
                    ids += [x + end for x in encoder.encode_all(waiting)]
                    waiting, size = [], 0
            ids += [x + end for x in encoder.encode_all(waiting)]
            counts = pa.array([len(x) // encoder.kind.itemsize for x in ids], pa.int64())
            rows = pa.array(np.arange(row, row + len(ids)))
            row += len(ids)
            wide = pa.array([encoder.kind.itemsize == 4] * len(ids), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column(0), batch.column(1), counts, pa.array(ids, pa.binary()), wide],
                names=["row", "doc_id", "source", "doc_tokens", "ids", "wide"],
            )

    def forget() -> None:
        if vocabulary in _ENCODERS:
            _ENCODERS[vocabulary].forget()

    kinds = dict(docs.dtypes)
    schema = f"row long, doc_id {kinds['doc_id']}, source {kinds['source']}, doc_tokens long, ids binary, wide boolean"
    return docs.select("doc_id", "source", "text").mapInArrow(handing_back(run, forget), schema)


def quanta(tokens: DataFrame, window: int, targets: dict[str, float] | None) -> DataFrame:
    """Tokens that each source's deficit gains in a round: its target share of a window.

    Without ``targets`` the shares are those of the corpus, so all queues last to the end. With them,
    sources not named get an even part of the smallest target given. A queue that runs dry leaves its
    part of later windows to the others.
    """
    totals = tokens.groupBy("source").agg(F.sum("doc_tokens").alias("total"))
    if targets:
        given = target_table(tokens, targets)
        share = F.coalesce(F.col("target"), F.lit(min(targets.values())))
        shares = totals.join(given, totals["source"].eqNullSafe(given["name"]), "left").select("source", share.alias("s"))
    else:
        shares = totals.select("source", F.col("total").cast("double").alias("s"))
    whole = shares.agg(F.sum("s")).first()[0] or 1.0  # one number
    return shares.select("source", (F.col("s") / F.lit(float(whole)) * window).alias("quantum"))


def target_table(df: DataFrame, targets: dict[str, float]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(targets.items()), "name string, target double")


def rounds(tokens: DataFrame, window: int, grain: int, targets: dict[str, float] | None = None) -> DataFrame:
    """Packets (row, source, start, length, round): the round that serves each by its source's deficit."""
    queue = running_total(
        tokens.select("source", "doc_id", "row", "doc_tokens"),
        ["source", "doc_id", "row"], "doc_tokens", "before", within="source",
    )
    shares = quanta(tokens, window, targets)
    k = F.col("k") * grain
    packets = queue.select("source", "row", "doc_tokens", "before", F.explode(_steps("doc_tokens", grain)).alias("k"))
    length = F.least(F.lit(grain), F.col("doc_tokens") - k)
    joined = packets.join(shares.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    return joined.select(
        "source", "row", k.alias("start"), length.alias("length"),
        F.ceil((F.col("before") + k + length) / F.col("quantum")).alias("round"),
    )


def _steps(length: str, grain: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.floor((F.col(length) - 1) / grain))


def pack(
    docs: DataFrame, vocabulary: str, window: int = WINDOW, grain: int = GRAIN, targets: dict[str, float] | None = None
) -> DataFrame:
    """Pieces of all documents, placed: (doc_id, start, length, ids, doc_tokens, source, round, sequence_id, offset)."""
    tokens = materialize(tokenize(docs, vocabulary))
    placed = running_total(
        rounds(tokens, window, grain, targets), ["round", "source", "row", "start"], "length", "at"
    )
    last = F.floor((F.col("at") + F.col("length") - 1) / window)
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("at") / window), last)))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * window)
    end = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * window)
    pieces = cut.select(
        "row",
        F.struct(
            (F.col("start") + begin - F.col("at")).alias("start"), (end - begin).alias("length"),
            "round", "sequence_id", (begin % window).alias("offset"),
        ).alias("piece"),
    )
    # As many pieces as the document is long; the ids then meet them once, not once a piece.
    by_row = pieces.groupBy("row").agg(F.collect_list("piece").alias("pieces"))
    return by_row.join(tokens, "row")


def pieces(packed: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per piece with the crc32 of its ids as 32-bit integers, and the ids themselves if asked for."""
    kinds = dict(packed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out: dict[str, list] = {n: [] for n in names}
            for r in rows:
                ids = np.frombuffer(r["ids"], "<u4" if r["wide"] else "<u2").astype("<u4")
                for p in sorted(r["pieces"], key=lambda p: p["start"]):
                    own = ids[p["start"] : p["start"] + p["length"]].tobytes()
                    for n in ("start", "length", "round", "sequence_id", "offset"):
                        out[n].append(p[n])
                    for n in ("doc_id", "source", "doc_tokens"):
                        out[n].append(r[n])
                    out["ids_crc32"].append(zlib.crc32(own))
                    if with_ids:
                        out["ids"].append(own)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], types[n]) for n in names], names=names)

    source_types = {"doc_id": kinds["doc_id"], "source": kinds["source"]}
    columns = {
        "doc_id": source_types["doc_id"], "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint", "source": source_types["source"],
        "round": "bigint",
    }
    if with_ids:
        columns["ids"] = "binary"
    names = list(columns)
    arrow = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    types = {n: arrow[k] for n, k in columns.items()}
    return packed.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in columns.items()))
