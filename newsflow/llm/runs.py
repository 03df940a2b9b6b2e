"""Periodic runs of words by Baier grouping.

A run is a stretch of words that repeats with a smallest period and that no neighbouring word extends. Every run holds roots, Lyndon
words as long as its period, and each root is the longest Lyndon word that starts at its place, under the order of words or under the
reversed one. The first phase of Baier's suffix sorter groups the suffixes of a text by these longest Lyndon words, so it
yields the Lyndon array directly; places whose Lyndon length repeats at that distance are extended by longest common
extensions into runs.

A run of exponent e holds each of its words e times at least, so words that are rarer than that in their stretch cannot be in
one: texts are cut there first, again and again, and only what is left is grouped. That cut is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.functions.text import bind
from newsflow.llm.batches import fresh
from newsflow.llm.spans import mix, text_slices

LEAST_EXPONENT = 4
LEAST_LENGTH = 6
SPACE = r"[\x20\x09-\x0D]+"

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that starts at each place of a sequence of ranks.

    Suffixes lie in groups, sorted by the context their members are known to begin with; a group's members are a slice of
    ``order``. Groups are final from the highest down. The members of the highest open group leave the chain of open places; what is
    then left of a member is its predecessor, whose context ends where the member begins and grows by the member's. Members of
    a lower group that were extended become a group of their own above the rest of theirs, those extended more often higher.
    """
    n = len(ranks)
    found = np.argsort(ranks, kind="stable")
    sizes = np.bincount(np.unique(ranks, return_inverse=True)[1], minlength=1) if n else np.zeros(0, int)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    order = found.tolist()
    place = np.empty(n, dtype=np.int64)
    place[found] = np.arange(n)
    group = np.empty(n, dtype=np.int64)
    group[found] = np.repeat(starts[:-1], sizes)
    place, group = place.tolist(), group.tolist()
    stop = [0] * n
    context = [1] * n
    for first, last in zip(starts[:-1].tolist(), starts[1:].tolist()):
        stop[first] = last
    # the chain of open places; n stands for both of its ends
    before = [n, *range(n)]
    after = [*range(1, n + 1), 0]
    lengths = [0] * n
    last = n
    while last:
        first = group[order[last - 1]]
        size = context[first]
        extended: dict[int, int] = {}
        for at in sorted(order[first:last]):
            lengths[at] = size
            one, two = before[at], after[at]
            after[one], before[two] = two, one
            if one != n:
                extended[one] = extended.get(one, 0) + 1
        by_times: dict[int, list[int]] = {}
        for at, times in extended.items():
            by_times.setdefault(times, []).append(at)
        for times in sorted(by_times, reverse=True):
            old: dict[int, int] = {}
            for at in by_times[times]:
                of = group[at]
                end = stop[of]
                old.setdefault(of, end)
                end -= 1
                other, here = order[end], place[at]
                order[here], place[other] = other, here
                order[end], place[at] = at, end
                stop[of] = end
            for at in by_times[times]:
                group[at] = stop[group[at]]
            for of, end in old.items():
                new = stop[of]
                stop[new], context[new] = end, context[of] + times * size
        last = first
    return np.array(lengths, dtype=np.int64)


class Extensions:
    """Longest common extensions of a sequence, by sums of keyed powers that wrap at 64 bits and a search over doubled steps."""

    def __init__(self, ranks: np.ndarray) -> None:
        n = len(ranks)
        power = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
        power[0] = 1
        self.power = np.cumprod(power, dtype=np.uint64)
        keyed = mix(ranks.astype(np.uint64) + np.uint64(1)) * self.power[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keyed, dtype=np.uint64)])
        self.n = n

    def _equal(self, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from the places ``one`` and the later places ``two`` are alike."""
        left = (self.sums[one + size] - self.sums[one]) * self.power[two - one]
        return left == self.sums[two + size] - self.sums[two]

    def _search(self, most: np.ndarray, alike) -> np.ndarray:
        got = np.zeros(len(most), dtype=np.int64)
        step = 1 << int(max(self.n, 1)).bit_length()
        while step:
            size = got + step
            fits = np.flatnonzero(size <= most)
            got[fits[alike(fits, size[fits])]] += step
            step >>= 1
        return got

    def forward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words from ``one`` on and from ``two`` on are alike; ``one`` < ``two``."""
        return self._search(self.n - two, lambda at, size: self._equal(one[at], two[at], size))

    def backward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words before ``one`` and before ``two`` are alike."""
        return self._search(one, lambda at, size: self._equal(one[at] - size, two[at] - size, size))


def _stretch(ranks: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The run around place ``at`` with this period, word by word."""
    unlike = np.flatnonzero(ranks[:-period] != ranks[period:])
    cut = int(np.searchsorted(unlike, at))
    start = int(unlike[cut - 1]) + 1 if cut else 0
    end = int(unlike[cut]) if cut < len(unlike) else len(ranks) - period
    return start, end + period - start


def find_runs(ranks: np.ndarray, exponent: int = LEAST_EXPONENT, length: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``exponent`` (2 or more) periods and ``length`` words, by start, then period."""
    n = len(ranks)
    if n < max(exponent, length):
        return []
    _, ranks = np.unique(ranks, return_inverse=True)
    where, periods = [], []
    for turned in (ranks, -ranks):
        roots = lyndon_lengths(turned)
        at = np.arange(n)
        # a run of this exponent holds exponent - 1 whole roots one behind the other
        for step in range(1, exponent - 1):
            there = at + step * roots[at]
            inside = there < n
            at, there = at[inside], there[inside]
            at = at[roots[there] == roots[at]]
        where.append(at)
        periods.append(roots[at])
    at, period = np.concatenate(where), np.concatenate(periods)
    fits = at + period < n
    at, period = at[fits], period[fits]
    if not len(at):
        return []
    extend = Extensions(ranks)
    start = at - extend.backward(at, at + period)
    size = at + period + extend.forward(at, at + period) - start
    enough = size >= np.maximum(length, exponent * period)
    found = dict(zip(zip(start[enough].tolist(), size[enough].tolist(), period[enough].tolist()), at[enough].tolist()))
    runs = set()
    for (first, many, each), root in found.items():
        part = ranks[first:first + many]
        # equal sums of unlike words would make a run too long
        if not np.array_equal(part[each:], part[:-each]):
            first, many = _stretch(ranks, root, each)
        if many >= max(length, exponent * each):
            runs.add((first, many, each))
    return sorted(runs)


def _open_stretches(ranks: np.ndarray, bounds: np.ndarray, exponent: int, length: int) -> Iterator[tuple[int, int]]:
    """(first, last) stretches of texts, one behind the other, in which each word occurs ``exponent`` times; others hold no run."""
    at = np.arange(len(ranks))
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    while len(at):
        _, which, counts = np.unique(part * (int(ranks.max()) + 1) + ranks[at], return_inverse=True, return_counts=True)
        often = counts[which] >= exponent
        at, kept = at[often], part[often]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(kept) > 0)
        part = np.cumsum(new) - 1
        long = np.bincount(part, minlength=1)[part] >= max(length, exponent) if len(at) else new
        if often.all() and long.all():
            first = np.flatnonzero(new)
            yield from zip(at[first].tolist(), (at[np.append(first[1:], len(at)) - 1] + 1).tolist())
            return
        at, part = at[long], part[long]


def runs_of_texts(texts: list[list[bytes]], exponent: int = LEAST_EXPONENT, length: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    numbers: dict[bytes, int] = {}
    ranks = np.array([numbers.setdefault(word, len(numbers)) for words in texts for word in words], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for first, last in _open_stretches(ranks, bounds, exponent, length):
        row = int(np.searchsorted(bounds, first, side="right")) - 1
        base = first - int(bounds[row])
        out[row] += [(base + start, size, period) for start, size, period in find_runs(ranks[first:last], exponent, length)]
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    return [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(df: DataFrame, text: str = "text", exponent: int = LEAST_EXPONENT, length: int = LEAST_LENGTH) -> DataFrame:
    """``df`` with ``runs``, ``n_words`` and ``collapsed``; all rows and columns stay, columns of these names are replaced.

    ``runs`` has (start, length, period) of every run of at least ``exponent`` periods and ``length`` words, by start, then period;
    ``collapsed`` is the text's words joined by one space, without those a run contains after its first period. Words are what stands
    between ASCII white space, compared byte by byte. Null and blank texts have no word, no run and an empty ``collapsed``.
    Repeated rows are treated alike, and an empty table gives none. A text is worked on whole by one task, whose memory grows
    with its longest text (about 100 bytes a word, some 300 in stretches of words that recur).
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    made = {"runs": T.ArrayType(RUN), "n_words": T.LongType(), "collapsed": T.StringType()}
    kept = [name for name in df.columns if name.lower() not in made]
    base = df.select(*[F.col(f"`{name}`") for name in kept], F.col(f"`{text}`").alias(fresh(df, "words_of")))
    schema = T.StructType([*[base.schema[name] for name in kept], *[T.StructField(name, kind) for name, kind in made.items()]])
    fields = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(len(kept))):
                words = [x.encode("utf-8", "surrogatepass").split() for x in texts.to_pylist()]
                runs = runs_of_texts(words, exponent, length)
                columns = [batch.column(i).slice(first, len(texts)).cast(fields.field(i).type) for i in range(len(kept))]
                columns += [
                    pa.array([[dict(zip(RUN.names, run)) for run in found] for found in runs], fields.field("runs").type),
                    pa.array([len(x) for x in words], pa.int64()),
                    pa.array([b" ".join(collapse(x, found)) for x, found in zip(words, runs)], pa.binary()).cast(
                        fields.field("collapsed").type)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    # mapInArrow looks its columns up by name, which names with dots do not survive
    return base.toDF(*[f"c{i}" for i in range(len(kept) + 1)]).mapInArrow(read, schema)


def _repeated_tail(text: Column, key: Column) -> Column:
    """The text with its tail made periodic where the key's checksum ends in 0; as it is elsewhere."""
    checksum = F.crc32(key)
    number = F.floor(checksum / 10)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")

    def repeat(words: Column, start: Column, period: Column) -> Column:
        return F.array_join(F.transform(words, lambda word, at: F.when(at < start, word).otherwise(
            F.get(words, (start + F.pmod(at - start, period)).cast("int")))), " ")

    def build(words: Column) -> Column:
        start = F.pmod(number, F.size(words).cast("bigint"))
        return bind(start, lambda start: bind(1 + F.floor((F.size(words) - start) / (3 + F.pmod(number, F.lit(8)))),
                                              lambda period: repeat(words, start, period)))

    turned = bind(words, lambda words: F.when(F.size(words) > 0, build(words)).otherwise(""))
    return F.when(checksum % 10 == 0, turned).otherwise(text)


def op12_periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    Of runs with equal exact exponents the first by start, then period; four nulls without a run. A null doc_id counts as an
    empty one in the checksum.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = periodic_runs(documents.select("doc_id", _repeated_tail(F.col("text"), key).alias("text")))
    none = F.lit(None).cast(RUN)
    best = F.aggregate(F.col("runs"), none, lambda held, run: F.when(
        held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"]), run).otherwise(held))
    lines = F.array_join(F.transform("runs", lambda run: F.concat(
        run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","), run["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
