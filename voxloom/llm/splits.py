"""Train, validation and test splits that keep related records together, on a persisted component table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions.columns import pick
from voxloom.functions.labels import label_key
from voxloom.llm.clips import current_clips
from voxloom.sources.writers import Versions
from voxloom.storage import delete_path, new_path, write_table

QUARANTINE = "quarantine"
NODES = "kind string, node string, piece string, split string"
LINKS = "piece string, component string, batch int"


@dataclass(frozen=True)
class SplitConfig:
    """Target shares of the records, and the fineness of the assignment.

    ``large`` components at most are placed one by one, the others by ``buckets`` of their hash; both bound what the
    driver holds.  After ``compact_every`` batches a store's segments are written as one.
    """

    shares: tuple[tuple[str, float], ...] = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
    large: int = 1000
    buckets: int = 4096
    compact_every: int = 16


def _meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join by sorted partitions: written tables look small by their compressed files, which is no bound to broadcast."""
    return left.join(right.hint("merge"), on, how)


def pair_edges(metadata: DataFrame) -> DataFrame:
    """``(video_id, label, rows)`` once per pair of any row; ``rows`` counts the current clips that have the pair.

    Pairs of rows that later ones replaced still tie, with 0 clips.  Label is null where a video has a row without one,
    video where a label has; rows without either tie nothing and are left out.
    """
    both = lambda df, n: df.select("video_id", label_key(F.col("speaker")).alias("label"), F.lit(n).alias("n"))
    every = both(pick(metadata, "video_id", "speaker"), 0).unionByName(both(current_clips(metadata, "video_id", "speaker"), 1))
    return every.filter("video_id IS NOT NULL OR label IS NOT NULL").groupBy("video_id", "label").agg(F.sum("n").cast("long").alias("rows"))


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str, bool]:
    """A written table, its path and whether it has rows, known without another job.

    The count may be too high if a stage ran twice, but never 0 with rows nor the other way round.
    """
    seen = Observation()
    table, path = write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return table, path, bool(seen.get["n"])


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, root)`` for each node of ``edges`` (``a``, ``b``): nodes of one component, and only they, share a root.

    Nodes are ordered by a hash; a node points to the first of its neighbours, or to itself, if it is ahead of all.
    Two rounds of pointer jumping take it four pointers on; edges are then drawn between what their ends point to, and
    those within one node vanish.  As the order is random, even a chain loses more than half of its nodes a round, and
    as it stays for three rounds, the leaves of a hub, which first point to themselves or to it, meet at the first of
    them in the next round.  So rounds are logarithmic in the number of nodes.  Only pointers and edges that still tie
    two nodes are written; nothing but whether any is left reaches the driver.
    """
    spark = edges.sparkSession
    live, path, left = _written(edges.filter(F.col("a") != F.col("b")).select("a", "b"), "edges")
    levels: list[DataFrame] = []
    for turn in range(max_rounds):
        if not left:
            break
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn // 3), F.col(c)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        both = live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("x")).select("x.*")
        step = both.groupBy("node").agg(F.min(rank("to")).alias("first")).select("node", F.least(F.col("first"), rank("node"))["n"].alias("to"))
        for _ in range(2):
            step = _meet(step, step.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to"))
        step, _ = write_table(step, "pointers")
        levels.append(step)
        at = lambda c: step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_now"))  # noqa: E731, B023
        moved = _meet(_meet(live, at("a"), "a"), at("b"), "b").filter(F.col("a_now") != F.col("b_now"))
        rest, rest_path, left = _written(moved.select(F.greatest("a_now", "b_now").alias("a"), F.least("a_now", "b_now").alias("b")).distinct(), "edges")
        delete_path(spark, path)
        live, path = rest, rest_path
    else:
        raise RuntimeError(f"components not settled in {max_rounds} rounds")
    if not levels:
        return spark.createDataFrame([], "node string, root string")
    roots = levels[0].withColumnRenamed("to", "root")
    for step in levels[1:]:  # what one level points to may have moved in the next
        roots = _meet(roots, step.select(F.col("node").alias("root"), F.col("to").alias("now")), "root", "left").select("node", F.coalesce("now", "root").alias("root"))
    return roots


def video_groups(metadata: DataFrame) -> DataFrame:
    """``(video_id, group_video_id)``: each video once, with the smallest video tied to it through shared labels.

    Null videos are left out; a video without label, or alone with its labels, is its own group.
    """
    pairs, _ = write_table(pair_edges(metadata).filter(F.col("video_id").isNotNull()), "pairs")
    video, label = F.concat(F.lit("v:"), "video_id"), F.concat(F.lit("w:"), "label")
    roots = connected(pairs.filter("label IS NOT NULL").select(video.alias("a"), label.alias("b")))
    videos = _meet(pairs.select("video_id", video.alias("node")).distinct(), roots, "node", "left").select("video_id", F.coalesce("root", "node").alias("root"))
    return _meet(videos, videos.groupBy("root").agg(F.min("video_id").alias("group_video_id")), "root").select("video_id", "group_video_id")


def _largest_deficit(held: dict[str, float], shares: dict[str, float], total: float) -> str:
    return max(shares, key=lambda s: (shares[s] * total - held[s], shares[s]))


def place_components(sizes: DataFrame, held: dict[str, int], config: SplitConfig, total: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``(component, split)`` for new components (``component``, ``size``), filling the splits' deficits, and what is held then.

    ``held`` counts the records that each split has already, ``total`` those of ``sizes`` if known.  The largest
    components go one by one to the split with the largest deficit.  The small rest is ordered by hash: counts per hash bucket are summed ahead on the driver
    (``buckets`` numbers) and cuts are laid where the deficits end.  A bucket between two cuts goes to one split as a
    whole; only in the buckets that a cut falls into, at most one less than splits, are components ranked.
    """
    shares = dict(config.shares)
    held = {s: held.get(s, 0) for s in shares}
    total = sum(held.values()) + ((sizes.agg(F.sum("size")).first()[0] or 0) if total is None else total)
    rows = sizes.orderBy(F.desc("size"), "component").limit(config.large).collect()
    chosen = {}
    for row in rows:
        split = _largest_deficit(held, shares, total)
        chosen[row["component"]] = split
        held[split] += row["size"]
    spark = sizes.sparkSession
    placed = spark.createDataFrame(list(chosen.items()), "component string, split string")
    if len(rows) < config.large:
        return placed, held
    size, name = rows[-1]["size"], rows[-1]["component"]
    rest = sizes.filter((F.col("size") < size) | ((F.col("size") == size) & (F.col("component") > name))).withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(config.buckets)))
    weights = {r["bucket"]: r["w"] for r in rest.groupBy("bucket").agg(F.sum("size").alias("w")).collect()}
    room = {s: max(0.0, shares[s] * total - held[s]) for s in shares}
    scale = sum(weights.values()) / max(1e-9, sum(room.values()))
    bounds, edge = [], 0.0
    for s in shares:
        edge += room[s] * scale
        bounds.append((s, edge))
    # records ahead of each bucket; the splits of the buckets that no cut divides, and those that one does
    start, whole, cut = 0.0, {s: [] for s in shares}, {}
    for b in sorted(weights):
        of = [s for i, (s, upper) in enumerate(bounds) if upper > start and (bounds[i - 1][1] if i else 0.0) < start + weights[b]]
        if len(of) == 1:
            whole[of[0]].append(b)
        else:
            cut[b] = start
        for i, (s, upper) in enumerate(bounds):  # in a cut bucket true but for the component at the cut
            held[s] += max(0, round(min(upper, start + weights[b]) - max(bounds[i - 1][1] if i else 0.0, start)))
        start += weights[b]
    last = bounds[-1][0]
    split = F.lit(last)
    for s, _ in bounds[:-1]:
        if whole[s]:
            split = F.when(F.col("bucket").isin(whole[s]), s).otherwise(split)
    divided = F.col("bucket").isin(list(cut))
    out = placed.unionByName(rest.filter(~divided if cut else F.lit(True)).select("component", split.alias("split")))
    if not cut:
        return out, held
    ahead = F.sum("size").over(Window.partitionBy("bucket").orderBy(F.xxhash64("component", F.lit(1)), "component")) - F.col("size") / 2
    begin = F.lit(0.0)
    for b, x in cut.items():
        begin = F.when(F.col("bucket") == b, x).otherwise(begin)
    ranked = F.lit(last)
    for s, upper in reversed(bounds[:-1]):
        ranked = F.when(F.col("ahead") < upper, s).otherwise(ranked)
    return out.unionByName(rest.filter(divided).select("component", (begin + ahead).alias("ahead")).select("component", ranked.alias("split"))), held


class SplitStore:
    """Persisted component table in a folder; batches are added with ``update``, each as a segment of its own.

    Tables: ``nodes`` (kind, node, piece, split) of videos and labels, and ``links`` (piece, component, batch), whose last
    row per piece counts; the records that each split holds are noted with the version.  Nodes that come in one batch
    and hang together are a piece.  A piece never changes its split; components of several pieces merge by new rows of ``links``, a piece
    without any being its own component.  So a batch reads the table but writes only what it adds or changes.

    A newcomer tied to videos or labels of one split goes there; tied to none it fills a deficit.  Where a batch ties
    different splits, what is there stays, and only what ties them is quarantined: newcomers that meet two splits
    themselves, or else the newcomers that hang together between two splits, and rows between two splits.  Quarantined
    nodes tie nothing later on.  So no voice or video ever lies in two splits.
    """

    def __init__(self, spark: SparkSession, path: str, config: SplitConfig = SplitConfig()):
        self.spark, self.config, self.versions = spark, config, Versions(spark, path)

    def version(self) -> int:
        """Number of the last complete version; 0 before the first batch."""
        return self.versions.current()

    def _note(self) -> dict:
        version = self.version()
        return self.versions.note(version) | {"version": version} if version else {"version": 0, "held": {}, "nodes": [], "links": []}

    def _segments(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.versions.folder(v)}/{name}" for v in self._note()[name]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def nodes(self) -> DataFrame:
        """``(kind, node, piece, split)`` of all videos and labels."""
        return self._segments("nodes", NODES)

    def links(self) -> DataFrame:
        """``(piece, component)`` of the pieces that merged with others."""
        return self._segments("links", LINKS).groupBy("piece").agg(F.max_by("component", "batch").alias("component"))

    def update(self, pairs: DataFrame) -> None:
        """Add a batch of ``(video_id, label, rows)`` (see ``pair_edges``).

        A clip that an earlier batch had and that is emitted again counts again in the sizes, which only steer the
        shares.
        """
        note = self._note()
        fresh, batch = not note["version"], note["version"] + 1
        where = self.versions.folder(batch)
        pairs = pairs.select("video_id", "label", "rows", F.concat(F.lit("v:"), "video_id").alias("v"), F.concat(F.lit("w:"), "label").alias("w"))
        if fresh:
            none = F.lit(None).cast("string")
            tied = pairs.withColumns({"v_piece": none, "v_split": none, "w_piece": none, "w_split": none})
        else:
            old = lambda kind, c, p: self.nodes().filter(F.col("kind") == kind).select(F.col("node").alias(c), F.col("piece").alias(f"{p}_piece"), F.col("split").alias(f"{p}_split"))
            tied = _meet(_meet(pairs, old("video", "video_id", "v"), "video_id", "left"), old("label", "label", "w"), "label", "left")
        tied, _ = write_table(tied, "tied")

        new_v, new_w = F.col("v").isNotNull() & F.col("v_piece").isNull(), F.col("w").isNotNull() & F.col("w_piece").isNull()
        newcomers = tied.filter(new_v).select(F.lit("video").alias("kind"), F.col("video_id").alias("node"), F.col("v").alias("key")).unionByName(tied.filter(new_w).select(F.lit("label").alias("kind"), F.col("label").alias("node"), F.col("w").alias("key"))).distinct()
        both = tied.filter(new_v & new_w).select("v", "w")
        if fresh:
            cluster = self._clusters(newcomers, both).withColumns({"low": F.lit(None).cast("string"), "high": F.lit(None).cast("string")})
        else:
            met = lambda new, key, split: tied.filter(new & F.col(split).isNotNull() & (F.col(split) != QUARANTINE)).select(F.col(key).alias("key"), F.col(split).alias("split"))
            met = met(new_v, "v", "w_split").unionByName(met(new_w, "w", "v_split")).groupBy("key").agg(F.min("split").alias("low"), F.max("split").alias("high"))
            newcomers, _ = write_table(_meet(newcomers, met, "key", "left"), "newcomers")
            bridges = newcomers.filter("low <> high").select("key")
            for end in ("v", "w"):
                both = _meet(both, bridges.withColumnRenamed("key", end), end, "left_anti")
            reached = self._clusters(newcomers, both)
            spans = reached.groupBy("piece").agg(F.min("low").alias("of_low"), F.max("high").alias("of_high"))
            cluster = _meet(reached, spans, "piece").select("kind", "node", "key", "piece", F.col("of_low").alias("low"), F.col("of_high").alias("high"))
        given = F.when(F.col("low") != F.col("high"), QUARANTINE).otherwise(F.col("low"))
        cluster, _ = write_table(cluster.select("kind", "node", "key", "piece", given.alias("given")), "clusters")

        # a row's clips count for its video's piece, without a video for its label's, and not between two splits
        at = lambda c: cluster.select(F.col("key").alias(c), F.col("piece").alias("fresh"), "given")
        grown = tied.select("rows", F.coalesce("v", "w").alias("key"), F.when(F.col("v").isNotNull(), F.col("v_piece")).otherwise(F.col("w_piece")).alias("piece"), F.when(F.col("v").isNotNull(), F.col("v_split")).otherwise(F.col("w_split")).alias("split"), F.coalesce(F.col("v_split") != F.col("w_split"), F.lit(False)).alias("between"))
        sizes = _meet(grown.filter(F.col("piece").isNull()), at("key"), "key").groupBy(F.col("fresh").alias("piece")).agg(F.sum("rows").alias("size"))
        # labels whose clips all count for their videos have no size of their own
        sizes = _meet(cluster.select("piece", F.col("given").alias("split")).distinct(), sizes, "piece", "left").select("piece", "split", F.coalesce("size", F.lit(0)).alias("size"))
        if not fresh:
            sizes = sizes.unionByName(grown.filter("piece IS NOT NULL AND NOT between").groupBy("split").agg(F.sum("rows").alias("size")).select(F.lit(None).cast("string").alias("piece"), "split", "size"))
        sizes, _ = write_table(sizes, "sizes")
        added = {r["split"]: r["n"] for r in sizes.groupBy("split").agg(F.sum("size").alias("n")).collect()}
        held = {s: note["held"].get(s, 0) + added.get(s, 0) for s, _ in self.config.shares}
        placed, held = place_components(sizes.filter("split IS NULL").select(F.col("piece").alias("component"), "size"), held, self.config, added.get(None, 0))
        splits = sizes.filter("piece IS NOT NULL AND split IS NOT NULL").select("piece", "split").unionByName(placed.select(F.col("component").alias("piece"), "split"))
        _meet(cluster, splits, "piece").select("kind", "node", "piece", "split").write.mode("overwrite").parquet(f"{where}/nodes")
        if not fresh:
            self._merged(tied, cluster, batch).write.mode("overwrite").parquet(f"{where}/links")
        self.versions.complete(batch, {"held": held, "nodes": [*note["nodes"], batch], "links": [*note["links"], *([] if fresh else [batch])]})
        if len(note["nodes"]) + 1 >= self.config.compact_every:
            self._compact(batch + 1, held)

    def _clusters(self, newcomers: DataFrame, both: DataFrame) -> DataFrame:
        """``newcomers`` with their ``piece``: those that hang together through rows of newcomers only."""
        roots = connected(both.select(F.col("v").alias("a"), F.col("w").alias("b")))
        return _meet(newcomers, roots.withColumnRenamed("node", "key"), "key", "left").withColumn("piece", F.coalesce("root", "key")).drop("root")

    def _merged(self, tied: DataFrame, cluster: DataFrame, batch: int) -> DataFrame:
        """New rows of ``links``: of the pieces whose component is another now."""
        links, at = self.links(), lambda c: cluster.select(F.col("key").alias(c), F.col("piece").alias(f"{c}_fresh"))
        ends = _meet(_meet(tied.filter("v IS NOT NULL AND w IS NOT NULL"), at("v"), "v", "left"), at("w"), "w", "left")
        ends = ends.select(F.coalesce("v_piece", "v_fresh").alias("a"), F.coalesce("w_piece", "w_fresh").alias("b")).filter("a <> b").distinct()
        for c in ("a", "b"):
            ends = _meet(ends, links.withColumnRenamed("piece", c), c, "left").withColumn(c, F.coalesce("component", c)).drop("component")
        roots, _ = write_table(connected(ends), "roots")
        pieces = links.unionByName(roots.select(F.col("node").alias("piece"), F.col("node").alias("component"))).groupBy("piece").agg(F.max_by("component", F.col("component") != F.col("piece")).alias("component"))
        return _meet(pieces, roots.withColumnRenamed("node", "component"), "component").select("piece", F.col("root").alias("component"), F.lit(batch).alias("batch"))

    def _compact(self, version: int, held: dict[str, int]) -> None:
        """Write all segments as one version, so that reading doesn't open ever more files; the work spreads over batches."""
        where = self.versions.folder(version)
        self.nodes().write.mode("overwrite").parquet(f"{where}/nodes")
        self.links().withColumn("batch", F.lit(version)).write.mode("overwrite").parquet(f"{where}/links")
        self.versions.complete(version, {"held": held, "nodes": [version], "links": [version]})

    def groups(self) -> DataFrame:
        """``(video_id, group_video_id)``: each video with the smallest of its component, whatever splits it has."""
        videos = self.nodes().filter("kind = 'video'").select(F.col("node").alias("video_id"), "piece")
        if self._note()["links"]:
            videos = _meet(videos, self.links(), "piece", "left").withColumn("piece", F.coalesce("component", "piece"))
        videos = videos.select("video_id", F.col("piece").alias("component"))
        return _meet(videos, videos.groupBy("component").agg(F.min("video_id").alias("group_video_id")), "component").select("video_id", "group_video_id")

    def assign(self, clips: DataFrame) -> DataFrame:
        """``clips`` (``video_id``, ``speaker`` and more) with their ``split``.

        A clip whose video and label lie in different splits is quarantined; so is one with a video and label that no
        batch had.  A clip with neither is tied to nothing and goes by a hash of its columns.
        """
        of = lambda kind, c: self.nodes().filter(F.col("kind") == kind).select(F.col("node").alias(c), F.col("split").alias(f"split_{kind}"))
        keyed = clips.withColumn("split_label_key", label_key(F.col("speaker")))
        both = _meet(_meet(keyed, of("video", "video_id"), "video_id", "left"), of("label", "split_label_key"), "split_label_key", "left")
        place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in clips.dtypes if "map" not in kind]), F.lit(1_000_000)) / 1_000_000
        free, edge = F.lit(self.config.shares[-1][0]), 1.0
        for s, share in reversed(self.config.shares):
            free, edge = F.when(place < edge, s).otherwise(free), edge - share
        alone = F.col("video_id").isNull() & F.col("split_label_key").isNull()
        split = F.when(alone, free).when(F.col("split_video") != F.col("split_label"), QUARANTINE).otherwise(F.coalesce("split_video", "split_label", F.lit(QUARANTINE)))
        return both.select(*[c for c in clips.columns if c != "split"], split.alias("split"))


def _store(metadata: DataFrame, path: str | None, config: SplitConfig) -> SplitStore:
    return SplitStore(metadata.sparkSession, path or new_path(metadata.sparkSession, "splits"), config)


def split_clips(metadata: DataFrame, path: str | None = None, config: SplitConfig = SplitConfig()) -> DataFrame:
    """``(audio_file, split)`` of the current clips; ``path`` names a store that earlier batches filled."""
    store = _store(metadata, path, config)
    store.update(pair_edges(metadata))
    return store.assign(current_clips(metadata, "video_id", "speaker")).select("audio_file", "split")


def grouped_videos(metadata: DataFrame, path: str | None = None, config: SplitConfig = SplitConfig()) -> DataFrame:
    """``(video_id, group_video_id)`` from the component table after adding ``metadata`` to the store at ``path``."""
    store = _store(metadata, path, config)
    store.update(pair_edges(metadata))
    return store.groups()


def grouped_in_batches(metadata: DataFrame, path: str | None = None, config: SplitConfig = SplitConfig()) -> DataFrame:
    """``grouped_videos`` of two batches: the rows up to the middle of the times of emission, and the later ones.

    Rows without a time come with the second batch.
    """
    store = _store(metadata, path, config)
    at = F.unix_micros(F.col("emitted_at").cast("timestamp"))
    low, high = metadata.agg(F.min(at), F.max(at)).first()
    early = at <= ((low or 0) + (high or 0)) // 2
    for batch in (metadata.filter(early), metadata.filter(F.coalesce(~early, F.lit(True)))):
        store.update(pair_edges(batch))
    return store.groups()


def split_report(metadata: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """One row on ``split_clips``: clips, those quarantined, voices and videos in two splits, and whether shares are near.

    Shares are near if no split is further from its target than the largest group of clips that hang together.
    """
    store = _store(metadata, None, config)
    store.update(pair_edges(metadata))
    clips, _ = write_table(store.assign(current_clips(metadata, "video_id", "speaker")).withColumn("label", label_key(F.col("speaker"))), "assigned")
    torn = lambda key: clips.filter(F.col(key).isNotNull() & (F.col("split") != QUARANTINE)).groupBy(key).agg(F.min("split").alias("a"), F.max("split").alias("b")).agg(F.count_if(F.col("a") != F.col("b")).alias(f"torn_{key}"))
    largest = _meet(clips, store.groups(), "video_id", "left").groupBy(F.coalesce("group_video_id", "label")).agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"))
    counts = clips.agg(F.count("*").alias("clips"), F.count_if(F.col("split") == QUARANTINE).alias("quarantined"), *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s, _ in config.shares])
    one = lambda df: df.withColumn("one", F.lit(1))
    joined = one(counts).join(one(torn("label")), "one").join(one(torn("video_id")), "one").join(one(largest), "one")
    near = F.lit(True)
    for s, share in config.shares:
        near = near & (F.abs(F.col(f"n_{s}") - F.col("clips") * share) <= F.coalesce("largest", F.lit(0)) + 1)
    return joined.select("clips", "quarantined", F.col("torn_label").alias("torn_voices"), F.col("torn_video_id").alias("torn_videos"), near.alias("near"))
