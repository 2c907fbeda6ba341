"""Token ids in raw binary shards, with a minimal perfect hash index from document keys to their places.

A store is a folder:

  ids-00000.bin      little-endian ids of the documents of one shard, in ascending key order, nothing between them;
                     16 bits an id where the vocabulary allows, else 32
  index-00000.bin    one part of the index: keys go to parts by hash
  shards, parts      Parquet tables: file, number of ids and ids of all shards before it; file and size of each part

An index part holds a minimal perfect hash of its n keys after Belazzougui, Botelho and Dietzfelbinger's hash and
displace: keys fall into n/4 groups, and each group, largest first, gets the first seed that sends its keys to free
slots. A slot holds a 32-bit fingerprint of its key, the shard, the place in it and the number of ids. A look-up reads
one seed and one slot; a key that isn't there is found out by its fingerprint but for one in 2^32.

Files are written under a name of the attempt and then moved, so a task that is run again leaves whole files only.
Paths may be of any kind that pyarrow's file systems know.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import tokenizer_file
from .wordids import WIDE, word_encoder

GROUP = 4  # keys for each seed
KEYS_PER_PART = 1 << 16
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u4"), ("copies", "<u4")])
HEADER = np.dtype([("n", "<u8"), ("groups", "<u8")])


def _mix(key: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """64 bits from a 64-bit key and a seed."""
    with np.errstate(over="ignore"):
        h = key + np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _slot_of(keys: np.ndarray, seeds: np.ndarray | int, n: int) -> np.ndarray:
    return (_mix(keys, np.asarray(seeds, np.uint64) + np.uint64(2)) % np.uint64(n)).astype(np.int64)


def build_hash(keys: np.ndarray) -> np.ndarray:
    """The seed of each group for distinct 64-bit keys."""
    n = len(keys)
    groups = max(1, -(-n // GROUP))
    of = (_mix(keys, 1) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=groups)
    first = np.cumsum(sizes) - sizes
    seeds = np.zeros(groups, np.uint32)
    taken = np.zeros(n, bool)
    for g in np.argsort(-sizes, kind="stable").tolist():
        m = int(sizes[g])
        if not m:
            break
        own = keys[order[first[g]:first[g] + m]]
        tried, step = 0, 64
        while True:  # a block of seeds at a time
            block = np.arange(tried, tried + step, dtype=np.uint64)
            at = _slot_of(own[None, :], block[:, None], n)
            good = ~taken[at].any(1)
            if m > 1:
                ordered = np.sort(at, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            hit = np.flatnonzero(good)
            if len(hit):
                seeds[g] = tried + hit[0]
                taken[at[hit[0]]] = True
                break
            tried, step = tried + step, min(1 << 14, 4 * step)
    return seeds


def index_part(keys: np.ndarray, entries: np.ndarray) -> bytes:
    """File of an index part: keys distinct unsigned 64-bit numbers, entries of type SLOT without fingerprints."""
    seeds = build_hash(keys)
    n = len(keys)
    slots = np.zeros(n, SLOT)
    of = (_mix(keys, 1) % np.uint64(len(seeds))).astype(np.int64)
    filled = entries.copy()
    filled["print"] = (_mix(keys, 0) >> np.uint64(32)).astype(np.uint32)
    slots[_slot_of(keys, seeds[of], n)] = filled
    return np.array([(n, len(seeds))], HEADER).tobytes() + seeds.astype("<u4").tobytes() + slots.tobytes()


def look_up(part: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, whether the key is there) for each key."""
    n, groups = (int(x) for x in np.frombuffer(part, HEADER, 1)[0])
    seeds = np.frombuffer(part, "<u4", groups, HEADER.itemsize)
    slots = np.frombuffer(part, SLOT, n, HEADER.itemsize + 4 * groups)
    of = (_mix(keys, 1) % np.uint64(groups)).astype(np.int64)
    found = slots[_slot_of(keys, seeds[of], n)]
    return found, found["print"] == (_mix(keys, 0) >> np.uint64(32)).astype(np.uint32)


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def put(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    """Write a file that is whole or absent."""
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    partial = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as out:
        for chunk in chunks:
            out.write(chunk)
    whole = f"{path}/{name}"
    if system.get_file_info(whole).type != pa.fs.FileType.NotFound:  # of an attempt whose executor was lost
        system.delete_file(whole)
    system.move(partial, whole)


def get(folder: str, name: str, at: int = 0, size: int | None = None) -> bytes:
    system, path = _file_system(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        return file.read_at(file.size() - at if size is None else size, at)


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_store(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 1,
                model: str | None = None, shards: int | None = None) -> None:
    """Encode the documents and write a store. key is a long; null keys come first, and count as the smallest long.
    Rows are ranged by key and then by a number of their own, so that many rows of one key are spread over shards."""
    spark = docs.sparkSession
    path = model or tokenizer_file("word_bpe_49k.json")
    folder = as_uri(folder)
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = np.dtype("<u2") if _largest_id(path) < 1 << 16 else WIDE
    rows = docs.select(F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("key"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    ranged = rows.repartitionByRange(shards, "key", "_row").sortWithinPartitions("key", "_row").select("key", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(path)
        end = np.array([end_id], WIDE).tobytes()
        shard = TaskContext.get().partitionId()
        keys: list[np.ndarray] = []
        counts: list[int] = []

        def bodies() -> Iterator[bytes]:
            for batch in batches:
                keys.append(batch.column(0).to_numpy())
                for body in enc.bodies(batch.column(1)):
                    counts.append(len(body) // 4 + 1)
                    yield np.frombuffer(body + end, WIDE).astype(width).tobytes()

        put(folder, f"ids-{shard:05d}.bin", bodies())
        n = np.array(counts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64), pa.int64()),
             pa.array(np.full(len(n), shard, np.int32)), pa.array(np.cumsum(n) - n), pa.array(n)],
            names=["key", "shard", "at", "n"])

    ranged.mapInArrow(encode, "key long, shard int, at long, n long").write.parquet(f"{folder}/places")
    places = spark.read.schema("key long, shard int, at long, n long").parquet(f"{folder}/places")

    # A row for each shard, which holds as much as a task reads: that many are summed up in one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places.groupBy("shard").agg(F.sum("n").alias("n_ids")).select(
        "shard", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"),
        F.lit(width.itemsize).alias("width")).write.parquet(f"{folder}/shards")

    # A key of several documents has one entry: its first, and how many follow behind it.
    firsts = places.groupBy("key").agg(F.min(F.struct("shard", "at", "n")).alias("first"), F.count(F.lit(1)).alias("copies"))
    parts = max(1, -(-places.count() // KEYS_PER_PART))
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["part"].iloc[0])
        entries = np.zeros(len(frame), SLOT)
        for c in ("shard", "at", "n", "copies"):
            entries[c] = frame[c].to_numpy()
        body = index_part(frame["key"].to_numpy(np.int64).view(np.uint64), entries)
        put(folder, f"index-{number:05d}.bin", iter([body]))
        return pd.DataFrame({"part": [number], "keys": [len(frame)], "bytes": [len(body)]})

    firsts.select(part.alias("part"), "key", "first.*", "copies").groupBy("part").applyInPandas(
        index, "part int, keys long, bytes long").write.parquet(f"{folder}/parts")


def _largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


def places_of(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(key, shard, at, n, copies) of the keys that the index has, by look-ups in its parts. keys: distinct longs."""
    folder = as_uri(folder)
    parts = spark.read.schema("part int, keys long, bytes long").parquet(f"{folder}/parts").count()
    asked = keys.select(F.col("key"), F.pmod(F.xxhash64("key"), F.lit(max(1, parts))).cast("int").alias("part"))

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        part = get(folder, f"index-{int(frame['part'].iloc[0]):05d}.bin")
        own = frame["key"].to_numpy(np.int64)
        entry, there = look_up(part, own.view(np.uint64))
        return pd.DataFrame({"key": own[there], **{c: entry[c][there].astype(np.int64) for c in ("shard", "at", "n", "copies")}})

    return asked.groupBy("part").applyInPandas(find, "key long, shard int, at long, n long, copies long")


def read_ids(spark: SparkSession, folder: str, places: DataFrame, with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) for each document of the places, read from the shards' files; the further
    copies of a key are read behind its first, also where they go on in the next shards. with_ids adds the ids as
    little-endian 32-bit numbers."""
    folder = as_uri(folder)
    shards = spark.read.schema("shard int, n_ids long, before long, width int").parquet(f"{folder}/shards")
    stored = spark.read.schema("key long, shard int, at long, n long").parquet(f"{folder}/places")
    # Keys of one document are read at the place that the index gives; of those with copies, every place is looked up.
    single = places.filter("copies = 1").select("key", "shard", "at", "n")
    more = stored.join(places.filter("copies > 1").select("key"), "key", "left_semi").select("key", "shard", "at", "n")
    # A shard's places are dealt into runs, each read in one go.
    asked = single.union(more).join(shards, "shard").withColumn("run", F.floor(F.col("at") / (1 << 20)))

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", kind="stable")
        width = int(frame["width"].iloc[0])
        at, n = frame["at"].to_numpy(), frame["n"].to_numpy()
        low, high = int(at.min()), int((at + n).max())
        body = get(folder, f"ids-{int(frame['shard'].iloc[0]):05d}.bin", low * width, (high - low) * width)
        ids = np.frombuffer(body, f"<u{width}")
        wide = [ids[a - low:a - low + m].astype(WIDE).tobytes() for a, m in zip(at.tolist(), n.tolist(), strict=True)]
        out = pd.DataFrame({"key": frame["key"].to_numpy(), "start": frame["before"].to_numpy() + at, "n_tokens": n,
                            "ids_crc32": np.array([zlib.crc32(w) for w in wide], np.int64)})
        return out.assign(ids=wide) if with_ids else out

    return asked.groupBy("shard", "run").applyInPandas(
        read, "key long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def id_report(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write a store of the documents and read each of them back by its key: doc_id, start, n_tokens, ids_crc32. The
    store goes to a folder of its own in the shared folder if none is given. A null text counts as empty and has the
    end id alone."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    write_store(docs, folder, key, text)
    keys = docs.select(F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("key")).distinct()
    found = read_ids(spark, folder, places_of(spark, folder, keys))
    return found.select(F.when(F.col("key") != -(1 << 63), F.col("key")).alias("doc_id"), "start", "n_tokens", "ids_crc32")
