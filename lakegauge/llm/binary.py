"""Token ids as flat binary files.

Documents are range-partitioned and sorted by key; every task encodes its range and streams three files to the shared
folder: ids (flat unsigned integers), lengths, keys. The parts' bases are prefix sums of their id counts; a second pass
writes each part's 64-bit global document offsets. Readers map the files into memory. File names carry the attempt, and only
the manifest, written when a task's attempt has succeeded, says which files count, so tasks may run again.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import bounded_batches, whole
from lakegauge.session import materialise, scratch_path

_NULL_KEY = -(1 << 63)
#: entries of a worker's word caches before they start anew
CACHE = 400_000


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def _mapped(path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where the folder is a mounted one, else read."""
    from pyarrow import fs
    f, p = _fs(path)
    if f.get_file_info(p).size == 0:
        return np.empty(0, kind)
    if isinstance(f, fs.LocalFileSystem):
        return np.memmap(p, dtype=kind, mode="r")
    with f.open_input_file(p) as s:
        return np.frombuffer(s.read_buffer(), kind)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte that byte-level vocabularies use."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts with a lower-casing word-level BPE of the tokenizers library, caching the ids of each word.

    White space always separates words for such a tokenizer, so ids of a text are those of its words in a row. A text with
    white space that regular expressions and Python judge differently is encoded whole. A word of Latin letters, with
    punctuation behind it or not, goes to the BPE model directly; any other goes through the whole tokenizer.
    """

    _ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁤　﻿]")
    _TAIL = ".,!?;:"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 65536 else "I"
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _core(self, core: str) -> bytes:
        low = unicodedata.normalize("NFC", core).lower()
        got = self.cores.get(low)
        if got is None:
            if low.isalpha() and max(low) < "\u0250":
                at = self.letters
                got = self.pack([t.id for t in self.model.tokenize("".join([at[b] for b in low.encode()]))])
            else:
                got = self._whole(core)
            if len(self.cores) >= CACHE:
                self.cores.clear()
            self.cores[low] = got
        return got

    def _word(self, word: str) -> bytes:
        core = word.rstrip(self._TAIL)
        if core.isalpha() and max(core) < "\u0250":
            got = self._core(core)
            if len(core) < len(word):
                got += self._tail(word[len(core):])
        else:
            got = self._whole(word)
        if len(self.words) >= CACHE:
            self.words.clear()
        self.words[word] = got
        return got

    def _tail(self, marks: str) -> bytes:
        got = self.words.get(marks)
        if got is None:
            got = self.words[marks] = self._whole(marks)
        return got

    def __call__(self, text: str) -> bytes:
        if self._ODD.search(text):
            return self._whole(text)
        get, new = self.words.get, self._word
        return b"".join([get(w) or new(w) for w in text.split()])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary, kept with its word caches for all tasks of a Python worker."""
    return WordEncoder(path)


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all documents into files below ``folder``; returns the manifest (part, first, file, code, n_docs, n_ids, base).

    Documents are in ascending order of their whole-number key, null keys first, rows with equal keys in order of their
    texts. ``end_id`` follows every document, so null and empty texts have one id. An empty table gives an empty manifest.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        name = f"{folder}/ids-{part:06d}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        end, width = encode.pack([end_id]), array(encode.code).itemsize
        fs, path = _fs(name)
        outs, n_docs, n_ids, first = None, 0, 0, None
        for b in batches:
            if b.num_rows == 0:
                continue
            if outs is None:
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                outs = [fs.open_output_stream(f"{path}.{x}") for x in ("ids", "len", "key")]
                first = b.column(0)[0].as_py()
            coded = [encode(t) + end for t in b.column(1).to_pylist()]
            sizes = np.fromiter((len(c) // width for c in coded), "<i8", len(coded))
            keys = np.fromiter((_NULL_KEY if k is None else k for k in b.column(0).to_pylist()), "<i8", len(coded))
            for out, data in zip(outs, (b"".join(coded), sizes.tobytes(), keys.tobytes())):
                out.write(data)
            n_docs, n_ids = n_docs + len(coded), n_ids + int(sizes.sum())
        if outs:
            for out in outs:
                out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "file": name, "code": encode.code,
                                               "n_docs": n_docs, "n_ids": n_ids}], schema=schema)

    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("file", pa.string()), ("code", pa.string()),
                        ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    rows = docs.select(F.col(key).cast("long").alias("id"), whole(text).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    parts = materialise(ordered.mapInArrow(run, "part int, first long, file string, code string, n_docs long, n_ids long"),
                        "parts")
    before = Window.orderBy(F.col("first").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    based = materialise(parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))), "bases")
    done = spread(based).mapInArrow(_write_offsets, based.schema)
    return materialise(done, "manifest")


def spread(parts: DataFrame) -> DataFrame:
    """One row of the manifest is a whole file: deal the rows out, so that files are read in parallel."""
    return parts.repartition(max(1, parts.count()), "file")


def _write_offsets(batches):
    """Global offsets: where each document of a part starts, and behind the last one the end of the part."""
    for b in batches:
        for r in b.to_pylist():
            sizes = _mapped(r["file"] + ".len", "<i8")
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8") + r["base"]
            fs, path = _fs(r["file"] + ".off")
            with fs.open_output_stream(path) as out:
                out.write(offsets.tobytes())
        yield b


def read_ids(manifest: DataFrame, key: str = "doc_id", rows: int = 4096) -> DataFrame:
    """Documents from the files: key, start (ids before it), n_tokens, ids_crc32 (of the ids as unsigned 32-bit numbers)."""
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = _mapped(r["file"] + ".ids", "<u2" if r["code"] == "H" else "<u4")
                off, keys = _mapped(r["file"] + ".off", "<i8"), _mapped(r["file"] + ".key", "<i8")
                for at in range(0, len(keys), rows):
                    k, o = keys[at:at + rows], np.asarray(off[at:at + rows + 1])
                    piece = np.asarray(ids[o[0] - r["base"]:o[-1] - r["base"]]).astype("<u4")
                    cut = (o - o[0]).tolist()
                    crc = [zlib.crc32(piece[s:e]) for s, e in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k, pa.int64(), mask=np.asarray(k) == _NULL_KEY), pa.array(o[:-1]),
                        pa.array(np.diff(o)), pa.array(crc, pa.int64())], schema=schema)

    return spread(manifest).mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for files in the shared scratch folder."""
    return scratch_path(spark, "ids")
