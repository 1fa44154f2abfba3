"""Token ids as flat binary files.

A dataset is a folder of shards in ascending key order. A shard is a file of ids (unsigned 16-bit
if the vocabulary fits, else 32-bit, little endian), a file of 64-bit offsets (ids of all documents
before each document, over the whole dataset, and one more for the end), and a file of 64-bit keys.
A `manifest` table lists them. Documents are sorted by ranges of the key; each task streams its
range through the tokenizer into a shard of its own. Only then are the sizes known: their prefix
sums, one number per shard, give the bases with which a second step writes the offsets. Readers
memory-map the files.

A repeated task writes new files under new names, and only those of the task that counted are listed.

The tokenizer drops white space and never joins across it, so a text is the sequence of its words;
a worker encodes a word once and remembers its ids, up to a bound.

Cases: null and empty texts are the end id alone; rows without a key come first; rows of one key
are ordered by text; repeated rows are written again; an empty table gives an empty dataset; other
input columns are left out.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import batches
from lakemill.llm.files import Writer, fresh, mapped
from lakemill.llm.words import steps

#: Words, and runs of letters or signs in them, that a worker remembers.
_CACHE = 600_000
_RUNS = 400_000
#: Separators for Python, but not for the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")
#: Words that the tokenizer cuts into runs of letters, single digits and runs of other signs, whatever
#: stands around them: no apostrophe (contractions), no < or | (special tokens), Latin letters only.
_PLAIN = re.compile(r"""[A-Za-z0-9À-ÖØ-öø-ÿ!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~>]+""")
_RUN = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

_SHARD = "shard int, ids string, lengths string, keys string, width int, docs long, tokens long, nulls long"


class WordEncoder:
    """Ids of texts, word by word, with the tokenizers library.

    Words of plain signs are cut into the runs that the tokenizer's own pattern would find, and a run
    is given to its model once; all other words are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        letters = [chr(c) for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100))]
        self.bytes_of = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        # Whether runs really stand for themselves depends on the tokenizer: tried on all the signs above.
        trial = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) not in "'<|") + "".join(letters) + "Straße99 a_b"
        self.cuts = all(
            self._plain(w) == self._whole([w])[0] for w in [trial.replace(" ", ""), *trial, "año.", "x9!!", "ÉTÉ,", "E.U"] if w.strip()
        )

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        found = self.runs.get(run)
        if found is None:
            plain = run if run.isascii() else run.translate(self.bytes_of)
            found = self.runs[run] = array(self.code, [t.id for t in self.model.tokenize(plain)]).tobytes()
        return found

    def _plain(self, word: str) -> bytes:
        return b"".join([self._run(run) for run in _RUN.findall(word.lower())])

    def _learn(self, words: set[str]) -> None:
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > _CACHE:
            self.known, missing = {}, words
        if len(self.runs) > _RUNS:
            self.runs = {}
        rest = []
        for word in missing:
            if self.cuts and _PLAIN.fullmatch(word):
                self.known[word] = self._plain(word)
            else:
                rest.append(word)
        for low in range(0, len(rest), 20_000):
            part = rest[low : low + 20_000]
            self.known.update(zip(part, self._whole(part)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes."""
        cut = [[text] if text and _ODD.search(text) else (text or "").split() for text in texts]
        self._learn(set(itertools.chain.from_iterable(cut)))
        known = self.known
        return [b"".join([known[w] for w in words]) for words in cut]


_WORKER: dict[str, WordEncoder] = {}


def _shard_writer(folder: str, tokenizer: str, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORKER:
            _WORKER[tokenizer] = WordEncoder(tokenizer)
        encoder = _WORKER[tokenizer]
        stop = np.array([end], encoder.kind).tobytes()
        out: list[Writer] = []
        docs = tokens = nulls = 0
        for batch in batches:
            for step in _sliced(batch):
                if not out:
                    out = [Writer(fresh(folder, ending)) for ending in (".ids", ".lengths", ".keys")]
                found = [ids + stop for ids in encoder.encode(step.column("text").to_pylist())]
                lengths = np.array([len(x) // encoder.width for x in found], "<i8")
                out[0].stream.write(b"".join(found))
                out[1].add(lengths)
                out[2].add(step.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                docs, tokens, nulls = docs + len(found), tokens + int(lengths.sum()), nulls + step.column("id").null_count
        if out:
            for file in out:
                file.close()
            shard = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "ids": out[0].path, "lengths": out[1].path, "keys": out[2].path, "width": encoder.width,
                "docs": docs, "tokens": tokens, "nulls": nulls,
            }], pa.schema([
                ("shard", pa.int32()), ("ids", pa.string()), ("lengths", pa.string()), ("keys", pa.string()),
                ("width", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("nulls", pa.int64()),
            ]))

    return write


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    at = 0
    for step in steps(batch.column("text")):
        yield batch.slice(at, len(step))
        at += len(step)


def _offset_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                lengths = mapped(row["lengths"], "<i8", row["docs"])
                file = Writer(fresh(folder, ".offsets"))
                file.add(np.concatenate([[0], np.cumsum(lengths)]).astype("<i8") + row["base"])
                file.close()
                row["offsets"] = file.path
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*batch.schema, ("offsets", pa.string())]))

    return write


def written(
    docs: DataFrame, folder: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", shards: int | None = None,
) -> str:
    """Write the dataset of `docs` into `folder`; returns the folder."""
    spark = docs.sparkSession
    batches.small(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    made = (
        rows.repartitionByRange(shards, "id").sortWithinPartitions("id", "text")
        .mapInArrow(_shard_writer(folder, tokenizer, end), _SHARD).collect()  # one row per shard
    )
    made = sorted(made, key=lambda r: r["shard"])
    bases = list(itertools.accumulate((r["tokens"] for r in made), initial=0))
    listed = spark.createDataFrame([(*r, base) for r, base in zip(made, bases)], f"{_SHARD}, base long")
    manifest = listed.repartition(max(1, len(made))).mapInArrow(_offset_writer(folder), f"{_SHARD}, base long, offsets string")
    manifest.write.parquet(f"{folder}/manifest")
    return folder


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = mapped(row["ids"], f"<u{row['width']}", row["tokens"])
            offsets = mapped(row["offsets"], "<i8", row["docs"] + 1)
            keys = mapped(row["keys"], "<i8", row["docs"])
            for low in range(0, row["docs"], 4096):
                high = min(low + 4096, row["docs"])
                start = np.array(offsets[low : high + 1])
                local = start - row["base"]
                part = np.array(ids[local[0] : local[-1]])
                cut = local - local[0]
                digest = [zlib.crc32(part[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(keys[low:high]), mask=np.arange(low, high) < row["nulls"]), pa.array(start[:-1]),
                        pa.array(np.diff(start)), pa.array(digest, pa.int64()),
                    ],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )


def read(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of a dataset, from its files."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    rows = manifest.repartition(max(1, manifest.count()), "shard")
    return rows.mapInArrow(_reader, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", key)
