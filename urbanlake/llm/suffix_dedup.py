"""Suffix-array dedup: byte spans that also occur elsewhere, through a
logarithmic family of sparse suffix arrays.

A 200-byte string is judged by its suffix at one content-chosen anchor: the
leftmost smallest digest among its ``KEY``-byte strings.  Equal strings choose
the same anchor, so a suffix array over the anchors alone (about one byte in
85) finds every match.  Each anchor owns the run of strings that chose it.

Ingest: each batch gets its own suffix array, hash-sharded by the digest of
the suffix's first ``KEY`` bytes and, within a shard, sorted by suffix prefix
and digest.  Where that rank is taken, the array and the levels of rank 0, 1,
... up to the first free one are merged and written once, at that rank, so a
row is rewritten at most log2(batches) times.  The level is merge-scanned
against every other level for keys that meet.

Then, for entries whose key met another:
* entries with equal run text: all strings of the run repeat;
* entries that share a key but not the whole run: their strings are compared
  one by one through 128-bit digests of the actual 200 bytes, read again from
  the texts.
Keys with few different runs are compared side by side in sorted shards; keys
with many (a passage that a third of all documents share, with different
surroundings) by a count of their strings that is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import drop_table, per_batch, release_shuffles, utf8, written

KEY = 32
HALF = 128  # digests of 2**7 bytes; two of them, overlapping, cover a whole string
#: Bytes looked at together, few enough for a core's cache; longer texts are read in pieces whose runs are cut at the seam.
PIECE = 1 << 16
#: Bits of a digest that give way to a position within a piece.
LOW = (1 << 22) - 1
ENTRY = "p long, h long, c long, tid long, tid2 int, s int, a short, w short"


def _mix(a, b):
    """Digest of a pair of digests (arrays of unsigned 64-bit, wrapping)."""
    import numpy as np

    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _words(data):
    """The eight bytes that start at each byte, as a little-endian number."""
    import numpy as np

    return np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,)).copy()


def _digests(word, size: int):
    """Digests of the strings of ``size`` bytes (a power of two over 8) that
    start at each byte, from its ``_words``; shorter at the end, where no such
    string starts."""
    import numpy as np

    level, n = word * np.uint64(0x9E3779B97F4A7C15), 8
    level ^= level >> np.uint64(32)
    while n < size:
        level = _mix(level[:-n], level[n:]) if len(level) > n else level[:0]
        n *= 2
    return level


def _halves(key, at):
    """Digests of the ``HALF`` bytes at the places ``at``, from those of ``KEY`` bytes."""
    parts = [key[at + o] for o in range(0, HALF, KEY)]
    while len(parts) > 1:
        parts = [_mix(x, y) for x, y in zip(parts[::2], parts[1::2])]
    return parts[0]


def _least(h, span: int):
    """The leftmost smallest digest in each window of ``span``, its last bits
    replaced by its position."""
    import numpy as np

    low = np.uint64(LOW)
    out, n = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while n < span:
        more = min(n, span - n)
        out, n = np.minimum(out[:-more], out[more:]), n + more
    return out


def runs(data, starts, lengths, size: int):
    """Runs of the ``size``-byte strings of the texts that lie back to back in
    ``data``: (text, first start, anchor offset, run length - 1, prefix, key
    digest, run digest), starts within ``data``."""
    import numpy as np

    if len(data) < size:
        return None
    word = _words(data)
    key = _digests(word, KEY)
    least = _least(key, size - KEY + 1)
    n = len(least)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    for border in (starts, starts + lengths - size + 1):
        new[border[(border >= 0) & (border < n)]] = True
    s = np.flatnonzero(new)
    e = np.append(s[1:], n) - 1
    text = np.searchsorted(starts, s, side="right") - 1
    keep = s + size <= (starts + lengths)[text]
    if not keep.any():
        return None
    s, e, text = s[keep], e[keep], text[keep]
    x, over = (least[s] & np.uint64(LOW)).astype(np.int64), size - HALF
    w, a = e - s, x - s
    first, last = (_mix(_halves(key, at), _halves(key, at + over)) for at in (s, e))
    return text, s, a, w, word[x].byteswap(), key[x], _mix(first, _mix(last, (a * 1000 + w).astype(np.uint64)))


def _pieces(texts: list[bytes], size: int):
    """Texts as groups that lie back to back, of about ``PIECE`` bytes; a
    longer text is cut into pieces that overlap so that no string is lost.
    Yields (row, offset in the text, piece) lists."""
    group, held = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - size + 1), PIECE):
            piece = text[at : at + PIECE + size - 1]
            if held and held + len(piece) > PIECE:
                yield group
                group, held = [], 0
            group.append((row, at, piece))
            held += len(piece)
    if group:
        yield group


def text_id(text: Column) -> list[Column]:
    """Content address of a text: 64 and 32 bits of two independent digests."""
    crc = F.crc32(text.cast("binary"))
    return [F.xxhash64(text).alias("tid"), (crc - F.lit(1 << 31)).cast("int").alias("tid2")]


def suffix_array(texts: DataFrame, size: int = 200) -> DataFrame:
    """Sparse suffix array entries of ``texts`` (tid, tid2, text), unsorted."""

    def body(batch):
        import numpy as np
        import pyarrow as pa

        rows = utf8(batch.column(2))
        tid, tid2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        found = []
        for group in _pieces(rows, size):
            lengths = np.array([len(p) for _, _, p in group], np.int64)
            starts = np.cumsum(lengths) - lengths
            data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
            got = runs(data, starts, lengths, size)
            if got is not None:
                text, s, a, w, p, h, c = got
                row = np.array([r for r, _, _ in group])[text]
                at = np.array([o for _, o, _ in group])[text]
                found.append((p, h, c, tid[row], tid2[row], s - starts[text] + at, a, w))
        if not found:
            return None
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int16, np.int16)
        columns = []
        for k, kind in enumerate(kinds):
            column = np.concatenate([f[k] for f in found])
            columns.append(pa.array(column.astype(np.uint64).view(np.int64) if k in (0, 1, 2) else column.astype(kind)))
        return pa.RecordBatch.from_arrays(columns, names=["p", "h", "c", "tid", "tid2", "s", "a", "w"])

    return texts.select("tid", "tid2", "text").mapInArrow(per_batch(body), ENTRY)


class SuffixLevels:
    """Logarithmic family of sparse suffix arrays.

    ``add`` builds the suffix array of a batch, merges it with the levels of
    equal rank, merge-scans the result against the other levels and notes the
    keys that meet.  A rank-r level holds 2**r batches; ``levels`` has one table per
    rank.  ``entries`` are all suffixes whose key met another.
    """

    def __init__(self, size: int = 200):
        self.size, self.levels, self.met = size, {}, []

    def add(self, texts: DataFrame) -> None:
        level, rank, older = suffix_array(texts, self.size), 0, []
        while rank in self.levels:  # levels of rank 0, 1, ... merge at once with the batch
            older.append(self.levels.pop(rank))
            level, rank = level.unionByName(older[-1]), rank + 1
        level = self._sorted(level)
        for table in older:
            drop_table(table)
        self.met.append(self._merge_scan(level))
        self.levels[rank] = level
        release_shuffles(texts.sparkSession)

    def _sorted(self, entries: DataFrame) -> DataFrame:
        """A level: sharded by key digest (a large key goes to several shards),
        each shard sorted by suffix."""
        return written(entries.hint("rebalance", "h").sortWithinPartitions("p", "h", "c"), "suffix-level")

    def _merge_scan(self, new: DataFrame) -> DataFrame:
        """Keys of the level that a batch went into that repeat in it or occur in another level."""
        keys = new.select("h", F.lit(1).alias("mine"))
        for old in self.levels.values():
            keys = keys.unionByName(old.select("h", F.lit(0).alias("mine")))
        met = keys.groupBy("h").agg(F.count("*").alias("n"), F.max("mine").alias("mine")).where("n > 1 AND mine = 1")
        return written(met.select("h"), "suffix-met")

    def entries(self) -> DataFrame | None:
        """Entries whose key met another, as a table; None before any ``add``."""
        if not self.met:
            return None
        met, all_entries = self.met[0], None
        for more in self.met[1:]:
            met = met.unionByName(more)
        for level in self.levels.values():
            all_entries = level if all_entries is None else all_entries.unionByName(level)
        # both sides plainly shuffled, so that AQE can split a large key
        return written(all_entries.join(written(met.distinct(), "suffix-met"), "h", "left_semi"), "suffix-entries")

    def drop(self) -> None:
        for t in [*self.levels.values(), *self.met]:
            drop_table(t)
        self.levels, self.met = {}, []


def _listed(column) -> tuple:
    """How many structs each row's list has (null: none), and their fields side by side."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), column.flatten().flatten()


def _contexts(texts: DataFrame, size: int) -> DataFrame:
    """The text of each listed run (tid, tid2, text, runs), with its key."""

    def body(batch):
        import numpy as np
        import pyarrow as pa

        count, (h, n, k, s, w) = _listed(batch.column(3))
        if not len(h):
            return None
        rows = np.repeat(np.arange(len(count)), count)
        texts, ends = utf8(batch.column(2)), (s.to_numpy() + w.to_numpy() + size).tolist()
        run = [texts[i][a:b] for i, a, b in zip(rows.tolist(), s.to_pylist(), ends)]
        where = pa.array(rows)
        columns = [h, n, k, batch.column(0).take(where), batch.column(1).take(where), s, pa.array(run, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["h", "n", "k", "tid", "tid2", "s", "run"])

    return texts.mapInArrow(per_batch(body), "h long, n long, k long, tid long, tid2 int, s int, run binary")


def _strings(runs_: list[bytes], size: int):
    """(run, start in the run, digest, digest) of every string of the runs."""
    import numpy as np

    length = np.array([len(r) for r in runs_], np.int64)
    first = np.cumsum(length) - length
    data = np.frombuffer(b"".join(runs_), np.uint8)
    blocks = range(0, max(1, len(data) - HALF + 1), PIECE)
    half = np.concatenate([_digests(_words(data[i : i + PIECE + HALF - 1]), HALF) for i in blocks])
    count = length - size + 1
    run = np.repeat(np.arange(len(runs_)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    one, two = half[first[run] + at], half[first[run] + at + size - HALF]
    return run, at, _mix(one, two), _mix(two, one + np.uint64(1))


def _compare(rows, size: int):
    """Repeated strings among whole key groups (a pyarrow table of contexts):
    byte ranges of the rows that occur once, neighbours joined."""
    import numpy as np
    import pyarrow as pa

    run, at, x, y = _strings(rows["run"].to_pylist(), size)
    h = rows["h"].to_numpy().view(np.uint64)[run]
    x = _mix(x, h)
    order = np.argsort(x)
    x, y = x[order], y[order]
    same = x[1:] == x[:-1]
    if (y[1:] != y[:-1])[same].any():  # one digest of two alike: sort by both
        again = np.lexsort((y, x))
        order, x, y = order[again], x[again], y[again]
        same = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
    again = np.zeros(len(x), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # a string that a repeated run shares occurs at least twice, so it is a partner already
    again &= (rows["n"].to_numpy() == 1)[run]
    hits = np.flatnonzero(again)
    if not len(hits):
        return None
    new = np.append(True, (np.diff(hits) != 1) | (np.diff(run[hits]) != 0))
    first, last = hits[new], hits[np.append(np.flatnonzero(new)[1:], len(hits)) - 1]
    where, s = pa.array(run[first]), rows["s"].to_numpy()[run[first]]
    return pa.RecordBatch.from_arrays(
        [
            rows["tid"].combine_chunks().take(where),
            rows["tid2"].combine_chunks().take(where),
            pa.array((s + at[first]).astype(np.int32)),
            pa.array((s + at[last] + size).astype(np.int32)),
        ],
        names=["tid", "tid2", "at", "end"],
    )


#: Runs of different text under one key that a task compares at once; keys
#: with more are compared by a distributed count of their strings instead.
GROUP_RUNS = 8192


def _grouped(contexts: DataFrame, size: int) -> DataFrame:
    """Ranges from keys with few runs: key groups side by side in sorted shards."""

    def body(batches):
        import numpy as np
        import pyarrow as pa

        held, rows = [], 0
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                held.append(part)
                rows += part.num_rows
                if rows < 2 * 2048:
                    continue
                table = pa.Table.from_batches(held)
                h = table["h"].to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last key may go on
                if cut:
                    out = _compare(table.slice(0, cut), size)
                    if out is not None:
                        yield out
                    held = table.slice(cut).to_batches()
                    rows = table.num_rows - cut
        if rows:
            out = _compare(pa.Table.from_batches(held), size)
            if out is not None:
                yield out

    shards = contexts.repartition("h").sortWithinPartitions("h")
    return shards.mapInArrow(body, "tid long, tid2 int, at int, end int")


def _counted(contexts: DataFrame, size: int) -> DataFrame:
    """Ranges from keys with many runs: strings counted across the cluster."""

    def body(batch):
        import numpy as np
        import pyarrow as pa

        run, at, x, y = _strings(batch.column(3).to_pylist(), size)
        where = pa.array(run)
        s = batch.column(2).to_numpy()[run]
        columns = [pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), batch.column(0).take(where), batch.column(1).take(where)]
        columns += [pa.array((s + at).astype(np.int32)), batch.column(4).take(where)]
        return pa.RecordBatch.from_arrays(columns, names=["x", "y", "tid", "tid2", "at", "n"])

    rows = contexts.select("tid", "tid2", "s", "run", "n")
    strings = rows.mapInArrow(
        lambda batches: (body(b.slice(i, 2048)) for b in batches for i in range(0, b.num_rows, 2048)),
        "x long, y long, tid long, tid2 int, at int, n long",
    )
    again = written(strings.groupBy("x", "y").agg(F.sum("n").alias("n")).where("n > 1").select("x", "y"), "suffix-again")
    part = strings.where("n = 1").join(again, ["x", "y"], "left_semi")
    return part.select("tid", "tid2", "at", (F.col("at") + size).alias("end"))


def repeated_spans(texts: DataFrame, levels: SuffixLevels, group_runs: int = GROUP_RUNS) -> DataFrame:
    """(tid, tid2, spans): for each text with repeats, the byte ranges [at, end)
    of strings that start anywhere else too, as a table."""
    size, spark = levels.size, texts.sparkSession
    entries = levels.entries()
    levels.drop()
    release_shuffles(spark)
    classes = entries.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("tid", "tid2", "s", "w")).alias("one")
    )
    classes = written(classes, "suffix-classes")
    # a. runs that repeat as a whole
    whole = entries.join(classes.where("n > 1").select("h", "c"), ["h", "c"], "left_semi").select(
        "tid", "tid2", F.col("s").alias("at"), (F.col("s") + F.col("w") + size).alias("end")
    )
    whole = written(whole.distinct(), "suffix-whole")
    # b. runs that share a key, but differ: compare string by string, one text for each distinct run
    mixed = classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    runs_of = (
        classes.join(mixed, "h")
        .groupBy("one.tid", "one.tid2")
        .agg(F.collect_list(F.struct("h", "n", "k", "one.s", "one.w")).alias("runs"))
    )
    runs_of = written(runs_of, "suffix-partial")
    once = texts.groupBy("tid", "tid2").agg(F.any_value("text").alias("text"))
    read = once.join(runs_of, ["tid", "tid2"]).select("tid", "tid2", "text", "runs")
    contexts = written(_contexts(read, size), "suffix-contexts")
    release_shuffles(spark)
    few, many = contexts.where(F.col("k") <= group_runs), contexts.where(F.col("k") > group_runs)
    part = written(_grouped(few, size).unionByName(_counted(many, size)), "suffix-part")
    spans = whole.unionByName(part).groupBy("tid", "tid2").agg(F.collect_list(F.struct("at", "end")).alias("spans"))
    spans = written(spans, "suffix-spans")
    for t in (entries, classes, whole, runs_of, contexts, part):
        drop_table(t)
    release_shuffles(spark)
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_repeats(
    docs: DataFrame, text_col: str = "text", size: int = 200, batches: int = 4, carry: tuple[str, ...] = ("doc_id",), group_runs: int = GROUP_RUNS
) -> DataFrame:
    """One row per input row: the ``carry`` columns (others are not read),
    ``n_bytes``, ``kept`` (binary, the bytes left), ``spans`` (maximal removed
    byte ranges [at, end)) and ``kept_text`` (the whole characters left).

    Every byte covered by a ``size``-byte string that also starts anywhere
    else, in the same text or another, is removed; strings are judged on the
    input, matches never cross texts, and null is empty.  Texts shorter than
    ``size`` stay whole; copies lose everything.  An empty table gives an empty
    result.  ``batches``: how many slices of the texts the index takes in turn.
    """
    if size < 2 * KEY or size > 2 * HALF or size <= HALF:
        raise ValueError(f"size must be in {HALF + 1}..{2 * HALF}")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), text.alias("text")).select(
        "row", "text", *text_id(F.col("text"))
    )
    long = keyed.select("tid", "tid2", "text").where(F.octet_length("text") >= size)
    levels = SuffixLevels(size)
    for b in range(batches):
        levels.add(long.where(F.pmod("tid", F.lit(batches)) == b))
    spans = repeated_spans(long, levels, group_runs)

    def body(batch):
        import numpy as np
        import pyarrow as pa

        count, (at, end) = _listed(batch.column(2))
        ranges, last = list(zip(at.to_pylist(), end.to_pylist())), np.cumsum(count).tolist()
        texts, kept, cuts, whole = utf8(batch.column(1)), [], [], []
        for text, n, upto in zip(texts, count.tolist(), last):
            cut = merged(ranges[upto - n : upto])
            left = [text[a:b] for a, b in zip([0, *[b for _, b in cut]], [*[a for a, _ in cut], len(text)])]
            kept.append(b"".join(left))
            cuts.append(cut)
            # what a cut leaves of a character at its edge is dropped
            whole.append("".join([x.decode("utf-8", "ignore") for x in left]))
        flat = [x for cut in cuts for x in cut]
        pair = [pa.array([x[i] for x in flat], pa.int32()) for i in (0, 1)]
        first = pa.array(np.cumsum([0, *map(len, cuts)]), pa.int32())
        spans = pa.ListArray.from_arrays(first, pa.StructArray.from_arrays(pair, names=["at", "end"]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(kept, pa.binary()), spans, pa.array(whole, pa.string())],
            names=["row", "n_bytes", "kept", "spans", "kept_text"],
        )

    joined = keyed.join(spans, ["tid", "tid2"], "left").select("row", "text", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    schema = f"row {kind}, n_bytes long, kept binary, spans array<struct<at:int,end:int>>, kept_text string"
    return joined.mapInArrow(per_batch(body), schema).select("row.*", "n_bytes", "kept", "spans", "kept_text")
