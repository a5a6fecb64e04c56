"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt by ranges of doc_id and sorted, so file ``n`` holds the
documents between those of files ``n - 1`` and ``n + 1``. Each task writes

* ``ids-n.bin``: all token ids of its documents, one after another, little
  endian unsigned 16 bit (32 bit for a vocabulary beyond 65,536);
* ``docs-n.bin``: their doc_ids, signed 64 bit (the least number: null);
* ``lengths-n.bin``: their numbers of ids, unsigned 64 bit.

Prefix sums over the files' totals then give each file its base, and a second
job writes ``offsets-n.bin``: for each document the number of ids of all
documents before it, and the end, unsigned 64 bit. A reader maps the files to
memory and needs no parsing. Files are written under a name of the attempt and
then renamed, so a task that is run again replaces its own files with the same
bytes.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import save
from clickpulse.llm.wordhash import slices
from clickpulse.session import fresh_dir

END_ID = 0
NULL_ID = np.iinfo(np.int64).min
#: Distinct units of text whose ids a worker remembers (some 200 bytes each);
#: when full it starts anew. Results do not depend on it.
CACHE_UNITS = 800_000
#: ASCII marks other than the apostrophe (which may begin a piece like 's).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Ids that a reader without memory mapping holds at a time.
READ_BYTES = 8 << 20


class UnitEncoder:
    """Encodes texts with a byte-level BPE tokenizer, remembering units.

    Such a tokenizer cuts a text into pieces before it merges bytes, and always
    cuts before a space that a visible character follows, and before a line
    feed. The ids of a text are thus those of its units, one after another:
    the parts between single spaces, each with its space, and between line
    feeds. Where white space is anything but single, the whole text goes to
    the tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # each character of a token's name stands for one byte
        names = self.tokenizer.get_vocab()
        self.id_bytes = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.id_bytes[i] = len(name)
        self.units: dict[str, bytes | None] = {}
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, parts: set[str]) -> None:
        """Remember the ids of new parts. Words without white space are encoded
        as one text, whose ids are dealt back by their numbers of bytes. Marks
        at the end of a word of letters are a piece of their own."""
        ending = {}
        for p in parts:
            stem = p.rstrip(MARKS)
            if len(stem) < len(p) and stem.isalpha():
                ending[p] = stem
        words = parts.difference(ending).union(s for s in ending.values() if s not in self.units)
        plain = [p for p in words if p and not p[0].isspace() and len(p.split()) == 1 and not p[-1].isspace()]
        ids = np.array(self.tokenizer.encode("".join(" " + p for p in plain), add_special_tokens=False).ids, self.dtype)
        ends = np.cumsum([len(p.encode()) + 1 for p in plain])
        cuts = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends, side="left") + 1
        raw, size, first = ids.tobytes(), self.dtype.itemsize, 0
        for part, last in zip(plain, (cuts * size).tolist()):
            self.units[part] = raw[first:last]
            first = last
        for part, stem in ending.items():
            marks = part[len(stem):]
            if marks not in self.marks:
                self.marks[marks] = self.whole(marks)
            self.units[part] = self.units[stem] + self.marks[marks]
        for part in words.difference(plain):
            # white space at the start of a part would join the space before it
            single = part and (part[0] == "\n" or not part[0].isspace())
            self.units[part] = self.whole(part if part[0] == "\n" else " " + part) if single else None

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if len(self.units) > CACHE_UNITS or len(self.marks) > CACHE_UNITS:
            self.units.clear()
            self.marks.clear()
        split = [None if "\n\n" in t else t.replace("\n", " \n").split(" ") for t in texts]
        new: set[str] = set()
        for parts in split:
            if parts is not None:
                new |= set(parts[1:]).difference(self.units)
        if new:
            self._learn(new)
        known, out = self.units.__getitem__, []
        for text, parts in zip(texts, split):
            try:
                if parts is None:
                    raise TypeError
                rest = b"".join(map(known, parts[1:]))
                out.append((self.whole(parts[0]) if parts[0] else b"") + rest)
            except TypeError:  # some white space is not single
                out.append(self.whole(text))
        return out


_encoders: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder for each worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _publish(store: fs.FileSystem, temporary: str, final: str) -> None:
    if store.get_file_info(final).type != fs.FileType.NotFound and not isinstance(store, fs.LocalFileSystem):
        store.delete_file(final)
    store.move(temporary, final)


_PART = "part long, n_docs long, n_ids long"


def _write_part(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([END_ID], encode.dtype).tobytes()
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        attempt = uuid.uuid4().hex
        names = [f"{kind}-{part:06d}.bin" for kind in ("ids", "docs", "lengths")]
        temporary = [f"{base}/_{attempt}-{n}" for n in names]
        n_docs = n_ids = 0
        with (store.open_output_stream(temporary[0]) as ids, store.open_output_stream(temporary[1]) as docs,
              store.open_output_stream(temporary[2]) as lengths):
            for batch in batches:
                sizes, texts = [], batch.column("text")
                for first, last in slices(texts):
                    own = [found + end for found in encode.encode_all(texts.slice(first, last - first).fill_null("").to_pylist())]
                    ids.write(b"".join(own))
                    sizes.extend(len(found) // encode.dtype.itemsize for found in own)
                docs.write(batch.column("doc_id").fill_null(int(NULL_ID)).to_numpy().astype("<i8").tobytes())
                lengths.write(np.array(sizes, "<u8").tobytes())
                n_docs, n_ids = n_docs + len(sizes), n_ids + sum(sizes)
        for t, n in zip(temporary, names):
            _publish(store, t, f"{base}/{n}")
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_ids": [n_ids]})
    return run


def _write_offsets(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{base}/lengths-{row['part']:06d}.bin") as file:
                    lengths = np.frombuffer(file.read(), "<u8")
                offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.uint64)]).astype("<u8") + np.uint64(row["base"])
                final = f"{base}/offsets-{row['part']:06d}.bin"
                temporary = f"{base}/_{uuid.uuid4().hex}-offsets"
                with store.open_output_stream(temporary) as file:
                    file.write(offsets.tobytes())
                _publish(store, temporary, final)
            yield batch
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write the files of ``docs`` (doc_id, text) below ``folder``, a URI or
    path that all executors share, and return their list: (part, n_docs,
    n_ids, base), a row for each file with documents.

    Ascending doc_id, null first; equal ids by a hash of the text. Null texts
    are empty and hold the end id only.
    """
    # rows that are the same may lie in several files: a number tells them apart
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.col("nth")]
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("nth"))
             .repartitionByRange(*order).sortWithinPartitions(*order).drop("nth"))
    parts = save(dealt.mapInArrow(_write_part(folder, tokenizer), _PART), "token-parts").filter("n_docs > 0")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    based = parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = based.repartition(max(1, parts.count()))
    return save(spread.mapInArrow(_write_offsets(folder), _PART + ", base long"), "token-bases")


def _mapped(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def _read_part(folder: str, dtype: str):
    size = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                docs = _mapped(store, f"{base}/docs-{part:06d}.bin", "<i8")
                offsets = _mapped(store, f"{base}/offsets-{part:06d}.bin", "<u8").astype(np.int64)
                local = offsets - offsets[0]
                name = f"{base}/ids-{part:06d}.bin"
                with store.open_input_file(name) as file:
                    mapped = _mapped(store, name, dtype) if isinstance(store, fs.LocalFileSystem) else None
                    first = 0
                    while first < len(docs):  # whole documents of about READ_BYTES
                        last = max(first + 1, int(np.searchsorted(local, local[first] + READ_BYTES // size, "right")) - 1)
                        last = min(last, len(docs))
                        low, high = local[first], local[last]
                        ids = mapped[low:high] if mapped is not None else np.frombuffer(
                            file.read_at((high - low) * size, low * size), dtype)
                        wide = ids.astype("<u4")
                        crc = [zlib.crc32(wide[a - low:b - low]) for a, b in zip(local[first:last], local[first + 1:last + 1])]
                        own = np.asarray(docs[first:last])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own, pa.int64(), mask=own == NULL_ID), pa.array(offsets[first:last]),
                             pa.array(np.diff(offsets[first:last + 1])), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        first = last
    return run


def read_tokens(files: DataFrame, folder: str, dtype: str) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, and
    the CRC-32 of its ids as little-endian unsigned 32-bit integers."""
    return files.select("part").repartition(max(1, files.count())).mapInArrow(
        _read_part(folder, dtype), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents' ids below the shared folder and read them back."""
    folder = fresh_dir(docs.sparkSession, "llm-tokens")
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)
    files = write_tokens(docs, folder, tokenizer)
    return read_tokens(files, folder, encoder(tokenizer).dtype.str)
