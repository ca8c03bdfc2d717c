"""URL filters by a sorted digest array.

Rules are a host, a path beginning with `/`, and a verdict. A rule fits its host and all hosts below it, where
the url's path starts with the rule's path; the longest fitting rule wins, and urls that no rule fits get the default.

The filter is one file image: the 64-bit xxHash of every rule in ascending order, beside it the offsets of the full
rule strings, their verdicts and the strings. A task memory-maps the image, looks up all candidate keys of a batch by one
vectorised binary search, and confirms each hit against the stored string, so that two strings with one digest are
told apart. Candidates of a url are its host and each parent domain, with those path lengths that the rules have.

The image reaches tasks by broadcast while it is below `BROADCAST_BYTES`. Larger lists go the other way: the sorted
keys are cut into blocks of digest ranges of bounded size, and distinct candidate keys are dealt to the blocks.

Null urls and urls without `://` have empty host and path and get the default. Repeated rules count once (block wins over
allow); an empty list gives the default everywhere.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict)
Rule = tuple[str, str, str]
ALLOW, BLOCK = "allow", "block"
BROADCAST_BYTES = 64 << 20
MOST_LENGTHS = 1 << 16


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class DigestArray:
    """The sorted digests and full strings of a rule list, in one block of bytes."""

    MAGIC = b"digests1"

    @classmethod
    def image(cls, rules: Iterable[Rule]) -> bytes:
        verdicts: dict[str, str] = {}
        for host, path, verdict in rules:
            if not path.startswith("/"):
                raise ValueError("a rule's path starts with /")
            name = host.lower() + path
            verdicts[name] = BLOCK if BLOCK in (verdict, verdicts.get(name)) else verdict
        named = sorted((xxhash.xxh64_intdigest(n.encode()), n.encode(), v == BLOCK) for n, v in verdicts.items())
        digests = np.array([d for d, _, _ in named], "<u8")
        ends = np.cumsum([0, *[len(n) for _, n, _ in named]], dtype="<i8")
        lengths = np.array(sorted({len(n) - n.index(b"/") for _, n, _ in named}), "<i8")
        head = np.array([len(named), len(lengths)], "<i8")
        blocked = np.array([b for _, _, b in named], np.uint8)
        return b"".join([
            cls.MAGIC, head.tobytes(), lengths.tobytes(), digests.tobytes(), ends.tobytes(), blocked.tobytes(), *[n for _, n, _ in named],
        ])

    def __init__(self, image: bytes | mmap.mmap):
        n, kinds = np.frombuffer(image, "<i8", 2, 8).tolist()
        self.lengths = np.frombuffer(image, "<i8", kinds, 24)
        at = 24 + 8 * kinds
        self.digests = np.frombuffer(image, "<u8", n, at)
        self.ends = np.frombuffer(image, "<i8", n + 1, at + 8 * n)
        self.blocked = np.frombuffer(image, np.uint8, n, at + 16 * n + 8)
        self.names = at + 17 * n + 8
        self.image = image

    @classmethod
    def mapped(cls, image: bytes) -> DigestArray:
        """The image as a memory-mapped file; it has no name any more once it is mapped."""
        fd, path = tempfile.mkstemp(prefix="digests-")
        try:
            with os.fdopen(fd, "r+b") as f:
                f.write(image)
                f.flush()
                view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        finally:
            os.unlink(path)
        return cls(view)

    def name(self, k: int) -> bytes:
        return self.image[self.names + int(self.ends[k]): self.names + int(self.ends[k + 1])]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key, or -1."""
        digest = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digest)
        out = np.full(len(keys), -1)
        hits = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digest) if len(self.digests) else []
        for k in hits:
            place = int(at[k])
            while place < len(self.digests) and self.digests[place] == digest[k]:
                if self.name(place) == keys[k]:
                    out[k] = place
                    break
                place += 1
        return out


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[bytes]:
    """Possible rule strings of a url, longest first; `lengths` of rules' paths, rising."""
    raw = path.encode()
    fitting = [raw[:n] for n in lengths[: bisect_right(lengths, len(raw))]]
    labels = host.split(".")
    keys = [".".join(labels[k:]).encode() + p for k in range(len(labels)) for p in fitting]
    return sorted(keys, key=len, reverse=True)


_mapped: dict[str, DigestArray] = {}


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """(key, host, path, rule, verdict) for every row, with the image broadcast; a list of more than `BROADCAST_BYTES` is
    probed by blocks."""
    image = DigestArray.image(rules)
    if len(image) > BROADCAST_BYTES:
        listed = pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        return judge_by_blocks(pages, listed, len(image) // BROADCAST_BYTES + 1, key, url, default)
    sent = pages.sparkSession.sparkContext.broadcast(image)
    name = uuid.uuid4().hex

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _mapped:
            _mapped.clear()
            _mapped[name] = DigestArray.mapped(sent.value)
        array = _mapped[name]
        lengths = array.lengths.tolist()
        for batch in stream:
            keys, owner = [], []
            for row, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if path.startswith("/"):
                    own = candidates(host, path, lengths)
                    keys += own
                    owner += [row] * len(own)
            place = array.find(keys)
            rule, verdict = [None] * batch.num_rows, [default] * batch.num_rows
            for k in np.flatnonzero(place >= 0)[::-1].tolist():  # the longest of a row is the last to be written
                rule[owner[k]] = keys[k].decode()
                verdict[owner[k]] = BLOCK if array.blocked[place[k]] else ALLOW
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["key", "host", "path", "rule", "verdict"]
            )

    rows = pages.select(F.col(key).cast("long").alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return rows.mapInArrow(task, "key long, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


def judge_by_blocks(
    pages: DataFrame, rules: DataFrame, blocks: int, key: str = "page_id", url: str = "url", default: str = ALLOW, salts: int = 16
) -> DataFrame:
    """As `judge`, for a rule table (host, path, verdict) of any size.

    Block n holds the digests whose remainder is n. Candidate keys are made distinct before they are dealt to the
    blocks, and the few that hit are joined back with salted copies, so a host with a third of all urls is no hot key.
    """
    found = rules.select(F.octet_length("path").alias("n")).distinct()
    lengths: Sequence[int] = sorted(r[0] for r in found.limit(MOST_LENGTHS + 1).collect())
    if len(lengths) > MOST_LENGTHS:  # then every prefix of a url's path is a candidate
        lengths = range(1, found.agg(F.max("n")).first()[0] + 1)

    def explode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            row, name = [], []
            for k, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                own = candidates(host, path, lengths) if path.startswith("/") else []
                row += [k] * len(own)
                name += [o.decode("utf-8", "replace") for o in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(name, pa.string())], ["row", "name"])

    from tidemark.llm.staging import staged

    rows = staged(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias(key),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    ))
    wanted = rows.select("row", "host", "path").mapInArrow(explode, "row long, name string")
    block = F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int").alias("block")

    def probe(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        listed = [(n[: n.index("/")], n[n.index("/"):], v) for n, v in zip(left["name"].to_pylist(), left["verdict"].to_pylist())]
        array = DigestArray.mapped(DigestArray.image(listed))
        names = right["name"].to_pylist()
        place = array.find([n.encode() for n in names])
        hit = np.flatnonzero(place >= 0)
        verdict = [BLOCK if array.blocked[place[k]] else ALLOW for k in hit]
        return pa.table({"name": pa.array([names[k] for k in hit], pa.string()), "verdict": pa.array(verdict, pa.string())})

    listed = rules.select(F.concat(F.lower("host"), "path").alias("name"), "verdict").withColumn("block", block)
    asked = wanted.select("name").distinct().withColumn("block", block)
    found = listed.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(probe, "name string, verdict string")
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = wanted.withColumn("salt", F.pmod("row", F.lit(salts)).cast("int")).join(spread, ["name", "salt"])
    best = hits.groupBy("row").agg(F.max_by(F.struct("name", "verdict"), F.octet_length("name")).alias("best"))
    return rows.join(best, "row", "left").select(
        key, "host", "path", F.col("best.name").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
