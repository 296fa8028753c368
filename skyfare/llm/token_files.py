"""Token-id files: one zstandard frame for each document under a shared dictionary.

``write_token_files`` encodes whole texts with the tokenizers library, appends
an end id, orders the documents by id over the cluster and writes binary files
into a shared folder; ``read_token_files`` reads all of them as a DataFrame and
``read_documents`` opens single documents without reading a whole file.

A file: the frames, an Arrow stream with the index (id, start, n_tokens, offset,
length; ``start`` counts ids within the file), then a footer: offset of the
index (8 bytes, little-endian), bytes of an id (1 byte), SHA-256 of the
dictionary (32 bytes), magic.  The dictionary stands beside the files.

A null text counts as empty (the end id alone); invalid UTF-8 reads as U+FFFD.  Null ids come first; documents
of the same id stand in the order of a hash of their ids, repeated rows are
written each.  An empty table gives no file and an empty result.  Files are
written under a name of the attempt and renamed when complete, so that a
repeated task replaces its file.  The folder must be one that ``pyarrow.fs``
opens: a shared mount, HDFS or an object store.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfare.llm.common import prepare, slices, valid_texts, worker_state
from skyfare.llm.token_counts import shared_file
from skyfare.session import write_once

MAGIC = b"SKYT0001"
FOOTER = "<QB32s8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
SUFFIX = ".skyt"
DICTIONARY = "dictionary.zdict"
LEVEL = 3
#: Ids of a file, about: what a task holds while it writes or reads a file.
FILE_IDS = 1 << 23
#: Bytes of text that are encoded at once: the more, the more words repeat.
ENCODE_BYTES = 8 << 20
#: The dictionary is trained on about so many documents, each cut to so many bytes.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8192, 1 << 16
#: Fixed value: a pre-token pattern under which white space is always dropped, so words can be encoded one by one.
DROPS_WHITE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: ASCII signs that are one token together when a letter or digit comes before and nothing after them.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Up to here all Unicode versions agree what a letter is; but one character is two in lower case.
UNSETTLED = regex.compile(r"[^\u0000-\u012f\u0131-\u024f]")


def _ends_settled(word: bytes) -> bool:
    """Whether the word's last character is surely a letter or an ASCII digit."""
    if word[-1:].isalnum() or not word:
        return bool(word)
    last = word[-2:].decode(errors="replace")[-1:] if word[-1] >= 0x80 else ""
    return last.isalpha() and UNSETTLED.search(last) is None


class Encoder:
    """Ids of whole texts as little-endian integers of ``width`` bytes, by the tokenizers library."""

    #: Words of a generation, about; the words of the last two generations are kept.
    KEEP = 1 << 18
    #: Words given to the library at once.
    AT_ONCE = 1 << 14

    def __init__(self, content: bytes, width: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.kind = f"<u{width}"
        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        added = spec.get("added_tokens", [])
        lower = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = (first.get("behavior") == "Removed" and first.get("invert") is True
                        and first.get("pattern") == {"Regex": DROPS_WHITE} and len(added) > 0
                        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or t["content"].split() != [t["content"]]
                                    for t in added))
        self.to_lower = lower == ["NFC", "Replace", "Lowercase"]
        self.added = [t["content"].encode() for t in added]
        self.lower_added = [a.lower() for a in self.added]
        self.between = added[0] if added else None
        self.memory: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    def _texts(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _cut(self, ids: list[int], cuts: np.ndarray) -> list[bytes]:
        """Bytes of ids[cuts[i]:cuts[i + 1]]."""
        raw = np.array(ids, self.kind).tobytes()
        at = (cuts * np.dtype(self.kind).itemsize).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one pre-token each, encoded as one line."""
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        of = np.array(found.word_ids, np.int64)
        if not len(of) or of[-1] != len(words) - 1:
            raise ValueError("a word of letters is not one pre-token")
        return self._cut(found.ids, np.searchsorted(of, np.arange(len(words) + 1)))

    def _signs(self, words: list[str]) -> list[bytes]:
        """Ids of any words without an added token: one line with an added token between them."""
        found = self.library.encode(self.between["content"].join(words), add_special_tokens=False).ids
        ends = np.append(np.flatnonzero(np.array(found, self.kind) == self.between["id"]), len(found))
        starts = np.concatenate([[0], ends[:-1] + 1])
        pairs = self._cut(found, np.stack([starts, ends], axis=1).ravel())
        return pairs[::2]

    def _learn(self, words: list[bytes]) -> None:
        line = b" ".join(words)
        odd = {w for w in words if any(a in w for a in self.added)} if any(a in line for a in self.added) else set()
        self.memory.update(zip(odd, self._texts([w.decode() for w in odd]), strict=True))
        words = [w for w in words if w not in odd]
        # signs at the end, after a letter or digit, are a token of their own: both parts are looked up by themselves
        parts = [(core, w[len(core):]) if len(core := w.rstrip(SIGNS)) < len(w) and _ends_settled(core) else (w, b"")
                 for w in words]
        new = list({p for pair in parts for p in pair if p}.difference(self.cores))
        read = [p.decode() for p in new]
        settled = UNSETTLED.search(" ".join(read)) is None
        plain = [w.isalpha() and (settled or UNSETTLED.search(w) is None) for w in read]
        for kind, encode_line in ((True, self._letters), (False, self._signs)):
            own = [i for i, p in enumerate(plain) if p is kind]
            for at in range(0, len(own), self.AT_ONCE):
                part = own[at:at + self.AT_ONCE]
                self.cores.update(zip([new[i] for i in part], encode_line([read[i] for i in part]), strict=True))
        self.cores[b""] = b""
        get = self.cores.__getitem__
        self.memory.update((w, get(a) + get(b)) for w, (a, b) in zip(words, parts, strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._texts([t.decode() for t in texts])
        if len(self.memory) > self.KEEP:
            self.memory, self.older, self.cores = {}, self.memory, {}
        words = []
        for t in texts:  # at ASCII white space; in lower case where that can't make an added token or change NFC
            low = t.lower() if self.to_lower and b"\xcc" not in t and b"\xcd" not in t else t
            words.append((t if any(a in low for a in self.lower_added) else low).split())
        new = set().union(*words).difference(self.memory)
        known = new.intersection(self.older)
        self.memory.update(zip(known, map(self.older.__getitem__, known), strict=True))
        if new := list(new.difference(known)):
            self._learn(new)
        get = self.memory.__getitem__
        return [b"".join(map(get, w)) for w in words]


def _filesystem(folder: str):
    """(pyarrow file system, path in it) of a folder that Spark names."""
    if folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" not in folder:
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(folder)


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of serialized id arrays; small inputs get the samples themselves as content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def encoded(encoder, batches, end_id: int | None, width: int):
    """Arrow batches (id, n, ids) for batches (id, text): the ids of a slice are one flat array, cut at its texts' ends."""
    last = [] if end_id is None else [end_id]
    for batch in slices(batches, limit=ENCODE_BYTES):
        ids, ends = encoder.ragged(valid_texts(batch.column("text")))
        if last:
            ids = np.insert(ids, ends, last)
            ends = ends + np.arange(1, len(ends) + 1)
        offsets = (np.append(0, ends) * width).astype(np.int32)
        column = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [
            None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(f"<u{width}"))])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(ends, prepend=0), pa.int64()), column],
                                         names=["id", "n", "ids"])


def encode(docs: DataFrame, tokenizer_path: str, end_id: int | None, width: int) -> DataFrame:
    """(id, n, ids) with ids as little-endian integers of ``width`` bytes, for ``docs`` (id, text)."""
    content = shared_file(prepare(docs), tokenizer_path)

    def task(batches):
        from skyfare.llm.word_ids import RaggedEncoder  # builds on this module
        encoder = worker_state(("ragged", hash(content.value)), lambda: RaggedEncoder(content.value))
        yield from encoded(encoder, batches, end_id, width)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(task, f"id {kind}, n long, ids binary")


def _writer(folder: str, width: int, dictionary, file_ids: int):
    def task(batches):
        context = TaskContext.get()
        trained = _dictionary(dictionary.value)
        digest = hashlib.sha256(dictionary.value).digest()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
        fs, root = _filesystem(folder)
        frames, lengths, counts, ids, written = [], [], [], [], 0

        def close():
            nonlocal frames, lengths, counts, ids, written
            n, length = np.array(counts, np.int64), np.array(lengths, np.int64)
            index = pa.table({"id": pa.chunked_array(ids), "start": np.cumsum(n) - n, "n_tokens": n,
                              "offset": np.cumsum(length) - length, "length": length})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, index.schema) as stream:
                stream.write_table(index)
            name = f"part-{context.partitionId():07d}-{written:05d}{SUFFIX}"
            draft = f"{root}/_draft-{context.taskAttemptId()}-{name}"
            with fs.open_output_stream(draft) as out:
                for frame in frames:
                    out.write(frame)
                out.write(sink.getvalue())
                out.write(struct.pack(FOOTER, int(length.sum()), width, digest, MAGIC))
            fs.move(draft, f"{root}/{name}")
            row = pa.RecordBatch.from_pydict({"file": [name], "docs": [len(n)], "ids": [int(n.sum())]})
            frames, lengths, counts, ids, written = [], [], [], [], written + 1
            return row

        held = 0
        for batch in slices(batches, "ids"):
            for x, n in zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist(), strict=True):
                frames.append(packer.compress(x))
                lengths.append(len(frames[-1]))
                counts.append(n)
                held += n
            ids.append(batch.column("id"))
            if held >= file_ids:
                yield close()
                held = 0
        if frames:
            yield close()

    return task


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` as token-id files into ``folder``; returns one row for each file: file, docs, ids."""
    spark = prepare(docs)
    with open(tokenizer_path, "rb") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), end_id or 0])
    width = 2 if top < 1 << 16 else 4
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    staged = write_once(encode(docs, tokenizer_path, end_id, width), "token-files-ids")
    total, rows = staged.agg(F.sum("n"), F.count(F.lit(1))).first()
    # a hash decides which documents the dictionary is trained on; SAMPLE_DOCS bounds their number
    one_in = max(1, (rows or 0) // SAMPLE_DOCS)
    sample = (staged.filter(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(one_in)) == 0)
              .select(F.expr(f"substring(ids, 1, {SAMPLE_BYTES})").alias("x")).limit(2 * SAMPLE_DOCS).collect())
    cut = [bytes(r["x"]) for r in sample]
    content = train_dictionary([x for x in cut if x])
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{DICTIONARY}") as out:
        out.write(content)
    files = max(1, -(-(total or 0) // file_ids))
    ordered = (staged.withColumn("tie", F.xxhash64("ids")).repartitionByRange(files, "id", "tie")
               .sortWithinPartitions("id", "tie").drop("tie"))
    dictionary = spark.sparkContext.broadcast(content)
    return write_once(ordered.mapInArrow(_writer(folder, width, dictionary, 2 * file_ids),
                                         "file string, docs long, ids long"), "token-files-manifest")


def _open(content, trained, digest: bytes):
    """(bytes of an id, index table, decompressor) of a file's content; checks magic and dictionary."""
    at, width, needs, magic = struct.unpack(FOOTER, content[-FOOTER_BYTES:])
    if magic != MAGIC or needs != digest:
        raise ValueError("not a token-id file of this dictionary")
    index = pa.ipc.open_stream(pa.py_buffer(content[at:-FOOTER_BYTES])).read_all()
    return width, index, zstandard.ZstdDecompressor(dict_data=trained)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, id_type: str = "bigint",
                     id_col: str = "doc_id") -> DataFrame:
    """All documents of a folder: id, start (ids before it over all files), n_tokens, ids (little-endian uint32).

    ``manifest`` is what ``write_token_files`` returned; its one row for each
    file gives the ids that stand in the files before.
    """
    fs, root = _filesystem(folder)
    with fs.open_input_stream(f"{root}/{DICTIONARY}") as f:
        content = f.read()
    dictionary = spark.sparkContext.broadcast(content)

    def task(batches):
        trained, digest = _dictionary(dictionary.value), hashlib.sha256(dictionary.value).digest()
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = data.as_buffer().to_pybytes()
                width, index, unpacker = _open(data, trained, digest)
                for part in index.to_batches(max_chunksize=256):
                    ids = []
                    for offset, length in zip(part.column("offset").to_pylist(), part.column("length").to_pylist(),
                                              strict=True):
                        x = unpacker.decompress(data[offset:offset + length])
                        ids.append(np.frombuffer(x, "<u2").astype("<u4").tobytes() if width == 2 else x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.rsplit("/", 1)[-1]] * len(ids)), part.column("id"), part.column("start"),
                         part.column("n_tokens"), pa.array(ids, pa.binary())],
                        names=["file", "id", "start", "n_tokens", "ids"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
             .select("path", "content"))
    found = files.mapInArrow(task, f"file string, id {id_type}, start long, n_tokens long, ids binary")
    before = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    return found.join(bases, "file").select(
        F.col("id").alias(id_col), (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def read_documents(folder: str, file: str, places: list[int]) -> list[np.ndarray]:
    """Ids of the documents at ``places`` of one file, read by the offset index only."""
    fs, root = _filesystem(folder)
    with fs.open_input_stream(f"{root}/{DICTIONARY}") as f:
        content = f.read()
    trained, digest = _dictionary(content), hashlib.sha256(content).digest()
    with fs.open_input_file(f"{root}/{file}") as f:
        size = f.size()
        at, width, needs, magic = struct.unpack(FOOTER, f.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        if magic != MAGIC or needs != digest:
            raise ValueError("not a token-id file of this dictionary")
        index = pa.ipc.open_stream(pa.py_buffer(f.read_at(size - FOOTER_BYTES - at, at))).read_all()
        unpacker = zstandard.ZstdDecompressor(dict_data=trained)
        out = []
        for i in places:
            frame = f.read_at(index["length"][i].as_py(), index["offset"][i].as_py())
            out.append(np.frombuffer(unpacker.decompress(frame), f"<u{width}").astype(np.uint32))
    return out
