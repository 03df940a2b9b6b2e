"""URL filters by a sorted digest array.

The rules, each a host and a path prefix with a verdict, are kept as their sorted 64-bit xxhash keys beside their full strings. A URL's
candidate rules (its host and the domains above it, with the path cut to every length that rules have) are hashed and looked up by one
binary search per batch; where a key is found, the stored string is compared, so that colliding keys decide nothing. Tasks
map the index file into memory: Spark brings the file to every executor once, and processes of a machine share its pages.
"""

from __future__ import annotations

import bisect
import mmap
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import fresh, over_batches, small_batches
from newsflow.session import new_folder

MAX_INDEX_BYTES = 256 << 20
DEFAULT_VERDICT = "allow"
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_HEAD = 4


def url_host(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class DigestIndex:
    """The rules as one run of bytes: counts, sorted keys, verdict numbers, string ends, path lengths, verdicts and strings."""

    def __init__(self, buffer) -> None:
        head = np.frombuffer(buffer, dtype=np.int64, count=_HEAD)
        rules, lengths, names, text = (int(x) for x in head)
        at = _HEAD * 8
        self.keys = np.frombuffer(buffer, dtype=np.uint64, count=rules, offset=at)
        at += rules * 8
        self.ends = np.frombuffer(buffer, dtype=np.int64, count=rules, offset=at)
        at += rules * 8
        self.verdict = np.frombuffer(buffer, dtype=np.int64, count=rules, offset=at)
        at += rules * 8
        self.lengths = np.frombuffer(buffer, dtype=np.int64, count=lengths, offset=at).tolist()
        at += lengths * 8
        self.names = bytes(buffer[at:at + names]).decode().split("\n")
        at += names
        self.buffer, self.at = buffer, at

    @staticmethod
    def build(rules: Iterable[tuple[str, str, str]]) -> bytes:
        """Hosts are compared in lower case; of equal rules the last one's verdict holds."""
        final = {(host.lower(), path): verdict for host, path, verdict in rules}
        made = sorted((xxhash.xxh64_intdigest(_key(*rule)), _key(*rule), verdict) for rule, verdict in final.items())
        names = sorted({verdict for _, _, verdict in made})
        lengths = sorted({len(path) for _, path in final})
        text = b"".join(key for _, key, _ in made)
        labels = "\n".join(names).encode()
        return b"".join([
            np.array([len(made), len(lengths), len(labels), len(text)], dtype=np.int64).tobytes(),
            np.array([digest for digest, _, _ in made], dtype=np.uint64).tobytes(),
            np.cumsum([len(key) for _, key, _ in made], dtype=np.int64).tobytes(),
            np.array([names.index(verdict) for _, _, verdict in made], dtype=np.int64).tobytes(),
            np.array(lengths, dtype=np.int64).tobytes(), labels, text])

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """The place of each key's rule, or -1."""
        if not len(self.keys) or not wanted:
            return np.full(len(wanted), -1)
        digests = np.array([xxhash.xxh64_intdigest(key) for key in wanted], dtype=np.uint64)
        place = np.searchsorted(self.keys, digests)
        hit = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] == digests)
        found = np.full(len(wanted), -1)
        for at in hit:
            rule = int(place[at])
            while rule < len(self.keys) and self.keys[rule] == digests[at]:
                if self._string(rule) == wanted[at]:
                    found[at] = rule
                    break
                rule += 1
        return found

    def _string(self, rule: int) -> bytes:
        start = int(self.ends[rule - 1]) if rule else 0
        return bytes(self.buffer[self.at + start:self.at + int(self.ends[rule])])

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest rule that fits each host and path, and its verdict; of equally long ones that of the longer host."""
        wanted: list[bytes] = []
        shown: list[tuple[str, str]] = []
        counts = []
        for host, path in zip(hosts, paths):
            before = len(wanted)
            cuts = self.lengths[:bisect.bisect_right(self.lengths, len(path))] if host else []
            at = 0
            while cuts and at >= 0:
                domain = host[at:]
                for cut in cuts:
                    wanted.append(_key(domain, path[:cut]))
                    shown.append((domain, path[:cut]))
                dot = host.find(".", at)
                at = dot + 1 if dot >= 0 else -1
            counts.append(len(wanted) - before)
        found = self.find(wanted)
        rules: list[str | None] = []
        verdicts: list[str | None] = []
        first = 0
        for count in counts:
            fits = [i for i in range(first, first + count) if found[i] >= 0]
            first += count
            best = max(fits, key=lambda i: (len("".join(shown[i])), len(shown[i][0])), default=None)
            rules.append(None if best is None else "".join(shown[best]))
            verdicts.append(None if best is None else self.names[self.verdict[found[best]]])
        return rules, verdicts


def _key(host: str, path: str) -> bytes:
    return f"{host}\0{path}".encode("utf-8", "surrogatepass")


_mapped: dict[str, DigestIndex] = {}


def _index(name: str) -> DigestIndex:
    """The index of this process, mapped from the file that Spark brought."""
    if name not in _mapped:
        with open(SparkFiles.get(name), "rb") as file:
            _mapped[name] = DigestIndex(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    return _mapped[name]


def _publish(spark: SparkSession, content: bytes) -> str:
    """Write to the shared folder and have Spark bring it to every executor; the name there."""
    name = f"digests-{uuid.uuid4().hex}"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'urls')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, url: str = "url",
                default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path prefix, null if none fits) and ``verdict``.

    A rule (host, path, verdict) fits its host and all hosts below it if the URL's path starts with the rule's; the longest
    wins. Null URLs and those without ``://`` have an empty host and path, which no rule fits. Columns of these names are
    replaced, all rows stay. Raises ValueError if the index is larger than ``MAX_INDEX_BYTES``, which every executor holds once.
    """
    spark = pages.sparkSession
    content = DigestIndex.build(rules)
    if len(content) > MAX_INDEX_BYTES:
        raise ValueError(f"the rules take {len(content)} bytes; at most {MAX_INDEX_BYTES} are brought to each executor")
    small_batches(spark)
    name = _publish(spark, content)
    host, path = fresh(pages, "host_"), fresh(pages, "path_")
    base = [column for column in pages.columns if column not in ("host", "path", "rule", "verdict")]
    parsed = pages.withColumns({host: url_host(F.col(url)), path: url_path(F.col(url))}).select(
        *base, F.col(host).alias("host"), F.col(path).alias("path"))
    schema = T.StructType([
        *parsed.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def add(batch: pa.RecordBatch) -> dict:
        columns = {x: batch.column(i) for i, x in enumerate(batch.schema.names)}
        found, verdicts = _index(name).judge(columns["host"].to_pylist(), columns["path"].to_pylist())
        return columns | {"rule": found, "verdict": [default if x is None else x for x in verdicts]}

    return over_batches(parsed, add, schema)


def op10_url_filters(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    return filter_urls(pages.select("page_id", "url")).drop("url")


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
OP10_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
parsed AS (
  SELECT page_id, url, row_number() OVER () AS row,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT p.row, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.row ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS n
  FROM parsed p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parsed p LEFT JOIN fits f ON f.row = p.row AND f.n = 1
"""
