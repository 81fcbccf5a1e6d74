"""N-gram Jaccard join by prefix filtering under several global token orders.

Two sets can only reach the threshold if their prefixes (the first
``n - ceil(t * n) + 1`` tokens) share a token, under *every* global order of the tokens.
One order indexes the sets, and a pair must share so many tokens of its two prefixes that
what lies behind them can still make up the rest; a candidate must also share so many
under each further order.  These are told from short rows, the 16-bit hashes of the prefix
tokens; whole sets move only for pairs that pass every order, to be intersected exactly.
Every order puts tokens that many sets hold last, so that common passages hardly ever
reach a prefix.

The work is linear in a group of copies: equal sets are one node, and an index entry of
a heavy token with many sets links them to a few centres first.  Only sets that this
leaves in different components are compared in a second round, so no link between
components is lost and no pair inside one is emitted.

In that round a set only meets the smallest set of each heavy part (the heavy tokens of
a set).  That is enough: if two linked sets share heavy prefix tokens only, their light
tokens all lie in the prefixes and none is shared; each then links with the smallest set
of the other's heavy part, and these two link as well.  For the same reason a pair that
shares no light token needs an overlap within the smaller heavy part.  Pairs that share a
light token of a large run are found by these tokens and kept whatever their heavy parts.
A set whose heavy part lies within that of a linked set no larger than it need not be met
at all: whatever it links with by heavy tokens alone, the other links with too.  So of a
large group of copies with edits only those remain that no other stands for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probewatch.llm.common import components, distinct, give_back, mix, offered, settle, shingle_set, tidy, values

#: Tokens of about this many sets go last in each order; the table of them is bounded.
HEAVY_SETS, HEAVY_IN_TASK, HEAVY_TABLE = 12, 2, 1 << 20
#: Index entries up to this size emit all their pairs; larger ones start with centres.
RUN, CENTRES = 24, 3
ORDERS = 3
#: Rows of the candidate search: a pair with its shared prefix tokens, a centre's pair, an entry of a large run.
PAIR, STAR, REST = 0, 1, 2
#: Prefix tokens that one index task holds.
BUCKET_TOKENS = 1_500_000
#: Sets compared with one centre in one group.
CHUNK = 256


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def set_key(tokens: np.ndarray) -> int:
    """A 64-bit key of a set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        total = mix(tokens, 7).sum(dtype=np.uint64) + np.uint64(len(tokens)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([total], np.uint64))[0].view(np.int64))


def _scan(width: int):
    """Per document its set's size and key; per task the tokens that it saw often."""
    def run(batches):
        kept_tokens, kept_counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        pending, waiting = [], 0

        def fold():
            nonlocal kept_tokens, kept_counts, pending, waiting
            tokens = np.concatenate([np.repeat(kept_tokens, 0), *pending])
            pending, waiting = [], 0
            tokens.sort()
            # a token seen c times stays c - 1 times, so that those seen once take no further room
            tokens = tokens[1:][tokens[1:] == tokens[:-1]]
            edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]])) if len(tokens) else np.zeros(1, int)
            fresh, counts = tokens[edge[:-1]], np.diff(edge) + 1
            both, where = np.unique(np.concatenate([kept_tokens, fresh]), return_inverse=True)
            kept_counts = np.bincount(where, np.concatenate([kept_counts, counts]), len(both)).astype(np.int64)
            kept_tokens = both
            if len(kept_tokens) > HEAVY_TABLE:
                top = np.argpartition(kept_counts, -HEAVY_TABLE)[-HEAVY_TABLE:]
                top.sort()
                kept_tokens, kept_counts = kept_tokens[top], kept_counts[top]

        for batch in batches:
            ids = batch.column(0)
            sizes, keys, seen = [], [], set()
            for text in values(batch.column(1)):
                tokens = shingle_set(text, width)
                key = set_key(tokens) if len(tokens) else None
                sizes.append(len(tokens))
                keys.append(key)
                if key is not None and key not in seen:
                    seen.add(key)
                    pending.append(tokens)
                    waiting += len(tokens)
                    if waiting > 3_000_000:
                        fold()
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * n, pa.int32()), ids.cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.int64())], ["kind", "doc_id", "n", "key"])
        if pending:
            fold()
        often = kept_counts >= HEAVY_IN_TASK
        if often.any():
            m = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * m, pa.int32()), pa.array([None] * m, pa.int64()),
                 pa.array(kept_counts[often], pa.int64()),
                 pa.array(kept_tokens[often].view(np.int64), pa.int64())], ["kind", "doc_id", "n", "key"])
    return tidy(run)


def _in_order(tokens, heavy, weight, order):
    """Positions of the tokens in one global order: light tokens first, then by weight."""
    at = np.minimum(np.searchsorted(heavy, tokens), max(len(heavy) - 1, 0))
    load = np.where(heavy[at] == tokens, weight[at], 0) if len(heavy) else np.zeros(len(tokens), np.int64)
    return np.lexsort((mix(tokens, order + 1), load)), load


#: What an index entry knows of its set: key, size, and size and key of its heavy part.
_ABOUT = ("keys", "sizes", "parts", "part_keys")


def _index(width, percent, buckets, table):
    """Prefix tokens of each batch, one row for each bucket: bytes of the arrays."""
    def run(batches):
        heavy, weight = table.value
        for batch in batches:
            keys, sizes, parts, part_keys, tokens, seen = [], [], [], [], [], set()
            for text in values(batch.column(0)):
                all_tokens = shingle_set(text, width)
                if not len(all_tokens):
                    continue
                key = set_key(all_tokens)
                if key in seen:
                    continue
                seen.add(key)
                order, load = _in_order(all_tokens, heavy, weight, 0)
                keys.append(key)
                prefix = order[:prefix_length(len(all_tokens), percent)]
                sizes.append(len(all_tokens))
                tokens.append(all_tokens[prefix])
                # the heavy part counts only where a prefix reaches it
                reached = load[prefix[-1]] > 0
                parts.append(int((load > 0).sum()) if reached else 0)
                part_keys.append(set_key(all_tokens[load > 0]) if reached else 0)
            if not keys:
                continue
            own = np.repeat(np.arange(len(keys), dtype=np.int32), [len(t) for t in tokens])
            flat = np.concatenate(tokens)
            place = (mix(flat, 99) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(place, kind="stable")
            edge = np.searchsorted(place[by], np.arange(buckets + 1))
            # a column each: those of small numbers and zeros take hardly any room in the shuffle
            about = [np.array(x, kind) for x, kind in (
                (keys, np.int64), (sizes, np.int32), (parts, np.int32), (part_keys, np.int64))]
            rows = []
            for b in range(buckets):
                part = by[edge[b]:edge[b + 1]]
                if len(part):
                    used, local = np.unique(own[part], return_inverse=True)
                    rows.append((b, *[x[used].tobytes() for x in about], flat[part].tobytes(), local.astype(np.int32).tobytes()))
            for k in range(0, len(rows), 64):
                bucket, *blobs = zip(*rows[k:k + 64])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), *[pa.array(x, pa.binary()) for x in blobs]],
                    ["bucket", *_ABOUT, "tokens", "own"])
    return tidy(run)


def _enough(percent: int) -> str:
    """The shared prefix tokens and all tokens behind a prefix can make up the overlap that is needed."""
    behind = f"greatest(({percent} * n + 99) div 100, ({percent} * m + 99) div 100) - 1"
    return f"({100 + percent}) * (shared + {behind}) >= {percent} * (n + m)"


def _near(n, m, percent):
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _candidates(percent, table):
    """Candidate pairs of one bucket, and the entries of its large runs."""
    def run(rows: pa.Table) -> pa.Table:
        tokens, own, before = [], [], 0
        for key, token, place in zip(*(rows.column(c).to_pylist() for c in ("keys", "tokens", "own"))):
            tokens.append(np.frombuffer(token, np.uint64))
            own.append(np.frombuffer(place, np.int32) + before)
            before += len(key) // 8
        tokens, own = np.concatenate(tokens), np.concatenate(own)
        by = np.argsort(tokens, kind="stable")
        tokens, own = tokens[by], own[by]
        same = tokens[1:] == tokens[:-1]
        many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        tokens, own = tokens[many], own[many]
        sets = np.stack([np.frombuffer(b"".join(rows.column(c).to_pylist()), kind).astype(np.int64)
                         for c, kind in zip(_ABOUT, (np.int64, np.int32, np.int32, np.int64))], 1)[own]
        by = np.lexsort((sets[:, 0], tokens))
        tokens, sets = tokens[by], sets[by]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (sets[1:, 0] != sets[:-1, 0])
        tokens, sets = tokens[new], sets[new]
        heavy = table.value[0]
        is_heavy = heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens if len(heavy) else np.zeros(len(tokens), bool)
        keys, sizes = sets[:, 0], sets[:, 1]
        # a light token says nothing about what else is shared
        parts, part_keys = np.where(is_heavy, sets[:, 2], sizes), np.where(is_heavy, sets[:, 3], keys)
        edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]])) if len(tokens) else np.zeros(1, int)
        start, length = edge[:-1], np.diff(edge)
        left, right, star_a, star_b = [], [], [], []
        for m in range(2, RUN + 1):
            at = start[length == m]
            if len(at):
                i, j = np.triu_indices(m, 1)
                left.append((at[:, None] + i).ravel())
                right.append((at[:, None] + j).ravel())
        large = np.flatnonzero(length > RUN)
        rest = np.concatenate([np.arange(start[r], start[r] + length[r]) for r in large]) if len(large) else np.empty(0, int)
        if len(large):
            # Copies with edits have light tokens of their own, their origin has hardly any and
            # is about as large as they are; all runs of a group so choose about the same centres.
            edits = 4 * (1 - parts / sizes)
            for r in large:
                run_at = np.arange(start[r], start[r] + length[r])
                usual = np.median(sizes[run_at])
                cost = np.abs(sizes[run_at] - usual) / usual + edits[run_at]
                for c in run_at[np.lexsort((keys[run_at], cost))[:CENTRES]]:
                    star_a.append(np.full(len(run_at) - 1, c))
                    star_b.append(run_at[run_at != c])

        def near(one, other):
            one, other = (np.concatenate(x) if x else np.empty(0, int) for x in (one, other))
            keep = _near(sizes[one], sizes[other], percent)
            return one[keep], other[keep]

        # every shared token of a small run is counted, whatever its kind
        left, right = near(left, right)
        by = np.lexsort((keys[right], keys[left]))
        left, right = left[by], right[by]
        new = np.ones(len(left), bool)
        new[1:] = (keys[left[1:]] != keys[left[:-1]]) | (keys[right[1:]] != keys[right[:-1]])
        times = np.diff(np.append(np.flatnonzero(new), len(left)))
        left, right = left[new], right[new]
        star_a, star_b = near(star_a, star_b)
        keep = (100 + percent) * np.minimum(parts[star_a], parts[star_b]) >= percent * (sizes[star_a] + sizes[star_b])
        star_a, star_b = star_a[keep], star_b[keep]
        stars = np.unique(np.stack([keys[star_a], keys[star_b]], 1), axis=0) if len(star_a) else np.empty((0, 2), np.int64)
        # of an entry of a large run: 1 if its token is light
        light = (~is_heavy[rest]).astype(np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([PAIR, STAR, REST], [len(left), len(stars), len(rest)]), pa.int32()),
            "a": pa.array(np.concatenate([keys[left], stars[:, 0], tokens[rest].view(np.int64)])),
            "b": pa.array(np.concatenate([keys[right], stars[:, 1], keys[rest]])),
            "shared": pa.array(np.concatenate([times, np.zeros(len(stars), np.int64), light])),
            "n": pa.array(np.concatenate([sizes[left], np.zeros(len(stars), np.int64), sizes[rest]])),
            "m": pa.array(np.concatenate([sizes[right], np.zeros(len(stars), np.int64), parts[rest]])),
            "part": pa.array(np.concatenate([np.zeros(len(left) + len(stars), np.int64), part_keys[rest]]))})

    def whole(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            give_back()
    return whole


def _sketches(width, percent, table):
    """Of each set its key, size and the 16-bit hashes of its prefix tokens under every further order."""
    def run(batches):
        heavy, weight = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                keys, sizes, blobs = [], [], []
                for text in batch.column(0).slice(at, 512).to_pylist():
                    tokens = shingle_set(text, width)
                    if len(tokens):
                        p = prefix_length(len(tokens), percent)
                        keys.append(set_key(tokens))
                        sizes.append(len(tokens))
                        blobs.append(b"".join(
                            (tokens[_in_order(tokens, heavy, weight, k)[0][:p]] >> np.uint64(48)).astype(np.uint16).tobytes()
                            for k in range(1, ORDERS)))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], ["key", "n", "tokens"])
    return tidy(run)


def _sets(width):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                keys, blobs = [], []
                for text in batch.column(0).slice(at, 512).to_pylist():
                    tokens = shingle_set(text, width)
                    if len(tokens):
                        keys.append(set_key(tokens))
                        blobs.append(tokens.tobytes())
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array([len(x) // 8 for x in blobs], pa.int64()),
                         pa.array(blobs, pa.binary())], ["key", "n", "tokens"])
    return tidy(run)


def _intersect(percent):
    """Pairs of one centre that share enough prefix tokens under every further order.

    Tokens with equal hashes count as shared, so that no pair is lost.
    """
    def run(members: pa.Table, centre: pa.Table) -> pa.Table:
        kept_a, kept_b = [], []
        if members.num_rows and centre.num_rows:
            a, n = centre.column("key")[0].as_py(), centre.column("n")[0].as_py()
            held = np.zeros((ORDERS - 1, 1 << 16), bool)
            x = np.frombuffer(centre.column("tokens")[0].as_py(), np.uint16).reshape(ORDERS - 1, -1)
            for k in range(ORDERS - 1):
                held[k, x[k]] = True
            for b, m, blob in zip(*(members.column(c).to_pylist() for c in ("b", "n", "tokens"))):
                y = np.frombuffer(blob, np.uint16).reshape(ORDERS - 1, -1)
                behind = (percent * max(n, m) + 99) // 100 - 1
                if _near(n, m, percent) and all(
                        (100 + percent) * (int(held[k, y[k]].sum()) + behind) >= percent * (n + m) for k in range(ORDERS - 1)):
                    kept_a.append(a)
                    kept_b.append(b)
        return pa.table({"a": pa.array(kept_a, pa.int64()), "b": pa.array(kept_b, pa.int64())})
    return run


def _verify(percent, table):
    """Links of one centre by the exact test.  ``low`` is the end that the other one stands for:
    a set with its whole heavy part, no larger than it (ties by heavy tokens, then key)."""
    def run(members: pa.Table, centre: pa.Table) -> pa.Table:
        links = []
        if members.num_rows and centre.num_rows:
            heavy = table.value[0]

            def heavy_part(x):
                return x[heavy[np.minimum(np.searchsorted(heavy, x), len(heavy) - 1)] == x] if len(heavy) else x[:0]

            a = centre.column("key")[0].as_py()
            x = np.frombuffer(centre.column("tokens")[0].as_py(), np.uint64)
            hx = heavy_part(x)
            for b, blob in zip(members.column("b").to_pylist(), members.column("tokens").to_pylist()):
                y = np.frombuffer(blob, np.uint64)
                both = _shared(x, y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    hy = heavy_part(y)
                    first = (len(x), -len(hx), a) < (len(y), -len(hy), b)
                    less, more = (hy, hx) if first else (hx, hy)
                    inside = len(less) <= len(more) and _shared(less, more) == len(less)
                    links.append((a, b, (b if first else a) if inside else None))
        return pa.table({c: pa.array([x[k] for x in links], pa.int64()) for k, c in enumerate(("a", "b", "low"))})
    return run


def _shared(x, y) -> int:
    both = np.sort(np.concatenate([x, y]))
    return int((both[1:] == both[:-1]).sum())


def _met(pairs: DataFrame, sets: DataFrame, judge, schema: str) -> DataFrame:
    """What ``judge`` says of the pairs (a, b), given what ``sets`` holds of both ends.  A centre's pairs are dealt in chunks."""
    # repeated document ids may bring a set twice; the links stay the same
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("deg"))
    pairs = pairs.join(degree, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.ceil(F.col("deg") / CHUNK))).drop("deg")
    members = pairs.join(sets, pairs["b"] == sets["key"]).select("a", "chunk", "b", "n", "tokens")
    centres = pairs.select("a", "chunk").distinct().join(
        sets, F.col("a") == F.col("key")).select("a", "chunk", "key", "n", "tokens").toDF("centre", "part", "key", "n", "tokens")
    return members.groupBy("a", "chunk").cogroup(centres.groupBy("centre", "part")).applyInArrow(judge, schema)


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id",
                       text_col: str = "text", keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links).

    Texts are split at space and tab to carriage return after lower-casing A-Z; a set holds
    the distinct ``width``-word shingles (the whole sequence where there are fewer words),
    as 64-bit hashes.  Two rows link when ``100 * |x & y| >= percent * |x | y|``.  A null or
    empty text has size 0, no links and its own id as component.  Repeated rows stay
    repeated.  A null id is never the smallest; a component of null ids only is null.
    Other columns are ignored.  An empty table gives an empty result.  ``keyed`` adds
    ``set_key``, the hash of the row's set, and ``group_key``, which tells components apart
    where ids repeat; both are null without words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scanned = settle(texts.mapInArrow(_scan(width), "kind int, doc_id long, n long, key long"))
    rows = scanned.where("kind = 0").select("doc_id", "n", "key")
    heavy = (scanned.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= HEAVY_SETS).orderBy(F.desc("n"), "key").limit(HEAVY_TABLE).toPandas())
    heavy_keys = heavy["key"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(heavy_keys)
    table = spark.sparkContext.broadcast((heavy_keys[by], heavy["n"].to_numpy(np.int64)[by]))

    nodes = settle(rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    # by the number of prefix tokens: every bucket repeats what it knows of a set
    buckets = max(4, -(-total * (100 - percent) // 100 // BUCKET_TOKENS))
    index = texts.select("text").mapInArrow(
        _index(width, percent, buckets, table), f"bucket int, {', '.join(f'{c} binary' for c in _ABOUT)}, tokens binary, own binary")
    found = settle(index.groupBy("bucket").applyInArrow(
        _candidates(percent, table), "kind int, a long, b long, shared long, n long, m long, part long"))
    counted = (found.where(F.col("kind") == PAIR).groupBy("a", "b")
               .agg(F.sum("shared").alias("shared"), F.first("n").alias("n"), F.first("m").alias("m")))
    stars = found.where(F.col("kind") == STAR).select("a", "b")
    # two sets may share as many more tokens as both have in large runs, which are not counted here
    large = found.where(F.col("kind") == REST).groupBy("b").agg(F.count(F.lit(1)).alias("large"))
    likely = (counted.join(large.toDF("a", "large_a"), "a", "left").join(large.toDF("b", "large_b"), "b", "left")
              .withColumn("shared", F.col("shared") + F.least(F.coalesce("large_a", F.lit(0)), F.coalesce("large_b", F.lit(0)))))
    # a pair may come from either side; each is verified once
    pairs = settle(likely.where(_enough(percent)).select("a", "b").unionByName(stars)
                   .groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
                   .agg(F.first("a").alias("a"), F.first("b").alias("b")).select("a", "b"))
    rest = found.where(F.col("kind") == REST).select(
        F.col("a").alias("token"), F.col("b").alias("key"), "n", F.col("m").alias("h"), "part",
        (F.col("shared") == 1).alias("light"))

    def held(keys, of, schema):
        """What ``of`` tells of the sets with these keys; a set is made anew from a text that has it."""
        reps = settle(keys.distinct().join(nodes, "key").select("rep"))
        ids = offered(reps, reps.count(), 16)
        chosen = texts.join(ids, texts["doc_id"] == ids["rep"], "left_semi").unionByName(texts.where("doc_id is null"))
        return settle(chosen.select("text").mapInArrow(of, schema))

    def ends(pairs):
        return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))

    row = "key long, n long, tokens binary"
    sketches = held(ends(pairs).unionByName(rest.select("key")), _sketches(width, percent, table), row)

    def linked(pairs):
        """Links among the pairs: the further orders decide by short rows which whole sets move."""
        likely = settle(_met(pairs, sketches, _intersect(percent), "a long, b long").distinct())
        sets = held(ends(likely), _sets(width), row)
        return settle(_met(likely, sets, _verify(percent, table), "a long, b long, low long"))

    edges = linked(pairs)
    if rest.limit(1).count():
        label = components(edges)
        marked = settle(rest.join(label, rest["key"] == label["node"], "left")
                        .select("token", "key", "n", "h", "part", "light", F.coalesce("component", "key").alias("c")))
        split = marked.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
        left = marked.join(split, "token")

        def across(one, other, enough):
            """Pairs of different components, with the number of tokens that they share in these rows."""
            other = other.select("token", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("h").alias("h2"), F.col("c").alias("c2"))
            met = one.join(other, "token").where(f"c <> c2 and 100 * least(n, n2) >= {percent} * greatest(n, n2) and {enough}")
            met = met.select("token", F.when(F.col("key") < F.col("key2"), F.struct("key", "key2", "n", "n2")).otherwise(
                F.struct(F.col("key2").alias("key"), F.col("key").alias("key2"), F.col("n2").alias("n"), F.col("n").alias("n2"))).alias("p"))
            return met.groupBy(F.col("p.key").alias("a"), F.col("p.key2").alias("b")).agg(
                F.count_distinct("token").alias("often"), F.first("p.n").alias("n"), F.first("p.n2").alias("m"))

        # a set is left to the linked one that stands for it: with no light token shared, that links with all that it links with
        low = settle(edges.where("low is not null").select("low").distinct())
        heavies, lights = left.where("not light").join(low, F.col("key") == F.col("low"), "left_anti"), left.where("light")
        smallest = marked.where("not light").join(low, F.col("key") == F.col("low"), "left_anti").groupBy("part").agg(F.min(F.struct("n", "key")).alias("least")).select(F.col("least.key").alias("key"))
        # no light token shared: the overlap lies within both heavy parts
        apart = across(heavies, heavies.join(smallest.distinct(), "key"), f"{100 + percent} * least(h, h2) >= {percent} * (n + n2)")
        # light tokens shared: of heavy ones in large runs as many more as both have
        beyond = rest.where("not light").groupBy("key").agg(F.count(F.lit(1)).alias("large"))
        alike = (across(lights, lights, "key < key2")
                 .join(beyond.toDF("a", "large_a"), "a", "left").join(beyond.toDF("b", "large_b"), "b", "left")
                 .withColumn("often", F.col("often") + F.least(F.coalesce("large_a", F.lit(0)), F.coalesce("large_b", F.lit(0)))))
        either = apart.unionByName(alike.select("a", "b", "often", "n", "m"))
        beside = counted.select("a", "b", F.col("shared").alias("also"))
        more = (either.join(beside, ["a", "b"], "left").withColumn("shared", F.col("often") + F.coalesce("also", F.lit(0)))
                .where(_enough(percent)).select("a", "b").distinct())
        more = settle(more.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        if more.limit(1).count():
            edges = edges.unionByName(linked(more))
    label = components(edges)
    named = nodes.join(label, nodes["key"] == label["node"], "left").select(
        nodes["key"].alias("k"), "rep", F.coalesce("component", "key").alias("c"))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = settle(named.join(least, "c").select("k", "c", "component_id"))
    out = rows.join(named, rows["key"] == named["k"], "left")
    more = [F.col("key").alias("set_key"), F.col("c").alias("group_key")] if keyed else []
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *more)


def _with_key(width: int):
    def run(batches):
        for batch in batches:
            sets = (shingle_set(t, width) for t in values(batch.column("text")))
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "_set_key"])
    return tidy(run)


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One document of each component of ``jaccard_components``, with all its columns.

    The one with the smallest id stays; of different texts with that id the one with the
    smallest set key.  So different texts of one id stay both unless they are near copies,
    and near copies without ids leave one.  Of rows of one id and one set any one stays.
    Texts without words are near copies of nothing and all stay.
    """
    groups = settle(jaccard_components(docs, width, percent, keyed=True))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_key")
    heads = groups.where("set_key is not null").groupBy("group_key").agg(F.min(order).alias("h"))
    heads = heads.select(F.col("h.doc_id").alias("_id"), F.col("h.set_key").alias("_key"))
    clear = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or doc_id is null").limit(1).count() == 0
    if clear:  # the id tells the row
        stay = settle(heads.select("_id").unionByName(groups.where("set_key is null").select(F.col("doc_id").alias("_id"))))
        return docs.join(offered(stay, stay.count(), 16), F.col("doc_id") == F.col("_id"), "left_semi")
    copies = groups.groupBy(F.col("doc_id").alias("id"), F.col("set_key").alias("key")).agg(F.count(F.lit(1)).alias("_rows"))
    heads = settle(heads.join(copies, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key"))).select("_id", "_key", "_rows"))
    tagged = docs.mapInArrow(_with_key(width), T.StructType([*docs.schema.fields, T.StructField("_set_key", T.LongType())]))
    met = tagged.join(heads, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_set_key") == F.col("_key")))
    once = met.where("_rows = 1").unionByName(met.where("_rows > 1").dropDuplicates(["_id", "_key"]))
    return once.select(*docs.columns).unionByName(tagged.where("_set_key is null").select(*docs.columns))
