"""Personal recommendations, the popularity list and the browse clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.constants import CLUSTER_NAMES, SEED
from cadenza.functions.scalar import digest, hash_bucket
from cadenza.operators.sampling import seeded_sample
from cadenza.operators.similar import nearest
from cadenza.session import materialise

# Interactions that count, how many are kept, how many are seeds.
COUNTED_ACTIONS = ("click", "like")
KEPT_INTERACTIONS = 50
SEED_INTERACTIONS = 10
NEIGHBOURS_PER_SEED = 5


def last_interactions(events: DataFrame, n: int = KEPT_INTERACTIONS, user: str = "user_id", item: str = "track_id",
                      action: str | None = "action", order: Sequence[str] = ("ts", "event_id"),
                      actions: Sequence[str] = COUNTED_ACTIONS) -> DataFrame:
    """Each user's last ``n`` counted interactions with their age rank (1 = latest).

    Each task cuts its users to ``n`` rows before the shuffle, so one very active user is no hot spot.
    """
    if action is not None:
        events = events.filter(F.col(action).isin(list(actions)))
    latest = Window.partitionBy(user).orderBy(*[F.desc(c) for c in order])
    ranked = events.filter(F.col(item).isNotNull()).withColumn("age", F.row_number().over(latest))
    return ranked.filter(F.col("age") <= n)


def popularity_order(columns: Sequence[str], key: str, seed: int = SEED) -> list[Column]:
    """By rank if there is one, else by points, else a seeded shuffle; NULLs last, ties by key."""
    if "rank" in columns:
        return [F.asc_nulls_last("rank"), F.col(key)]
    if "points (total)" in columns:
        return [F.desc_nulls_last("`points (total)`"), F.col(key)]
    return [digest(key, seed), F.col(key)]


def popular(tracks: DataFrame, limit: int, key: str = "track_id", order: Sequence[Column] | None = None) -> DataFrame:
    return tracks.orderBy(*(order or popularity_order(tracks.columns, key))).limit(limit)


def seed_tracks(events: DataFrame, n: int = SEED_INTERACTIONS, **columns) -> DataFrame:
    """Each user's last ``n`` interactions, numbered from the oldest: ``(user, track, seed_position)``."""
    user, item = columns.get("user", "user_id"), columns.get("item", "track_id")
    recent = last_interactions(events, n, **columns)
    return recent.select(F.col(user).alias("user"), F.col(item).alias("seed"), (-F.col("age")).alias("seed_position"))


def neighbour_lists(seeds: DataFrame, tracks: DataFrame, index: DataFrame, key: str, vector: str,
                    neighbours: int = NEIGHBOURS_PER_SEED) -> DataFrame:
    """``(seed, neighbours)`` once per distinct seed track, whatever the number of users.

    A list is cut to its ``neighbours`` best before absent tracks are removed. It is stored, so the
    planner knows its size when it chooses how to join it.
    """
    known = tracks.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    wanted = known.join(seeds.select(F.col("seed").alias("id")).distinct(), "id", "left_semi")
    catalogue = index.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    hits = nearest(wanted, catalogue, neighbours, "id", "vector")
    if index is not tracks:
        hits = hits.join(known.select("id"), "id", "left_semi")
    hit = F.struct("rank", "id", "similarity")
    lists = hits.groupBy(F.col("query_id").alias("seed")).agg(F.array_sort(F.collect_list(hit)).alias("neighbours"))
    return materialise(lists, "neighbour-lists")


def personal_lists(seeds: DataFrame, lists: DataFrame) -> DataFrame:
    """``(user, hits)``: unseen neighbours of the user's seeds, the most similar first.

    The first seed that offers a track wins, even if a later one is closer to it. A user has at most
    seeds x neighbours offers, so each list stays small. A popular seed meets its one list row; AQE
    splits such a partition.
    """
    offer = F.struct("seed_position", "seed", "neighbours")
    users = seeds.join(lists, "seed", "left").groupBy("user").agg(F.array_sort(F.collect_list(offer)).alias("offers"))
    seen = F.transform("offers", lambda o: o["seed"])
    offered = F.flatten(F.transform("offers", lambda o: F.transform(
        F.coalesce(o["neighbours"], F.array()),
        lambda n: F.struct((-n["similarity"]).alias("order"), o["seed_position"].alias("seed_position"),
                           n["rank"].alias("rank"), n["id"].alias("id"), n["similarity"].alias("similarity")),
    )))
    unseen = F.filter("offered", lambda n: ~F.array_contains(F.col("seen"), n["id"]))
    first = F.filter("unseen", lambda n, i: F.array_position(F.transform("unseen", lambda m: m["id"]), n["id"]) == i + 1)
    return (
        users.withColumns({"seen": seen, "offered": offered}).withColumn("unseen", unseen)
        .select("user", F.array_sort(first).alias("hits"))
    )


def recommend(events: DataFrame, tracks: DataFrame, limit: int = 20, index: DataFrame | None = None,
              key: str = "track_id", vector: str = "vector", users: DataFrame | None = None,
              backfill: bool = False, seeds: int = SEED_INTERACTIONS, neighbours: int = NEIGHBOURS_PER_SEED,
              popularity: Sequence[Column] | None = None, **columns) -> DataFrame:
    """Recommendations for every user in one job: ``(user, position, id, similarity, source)``.

    A user with fewer than ``limit`` personal hits gets the popularity list instead, or with
    ``backfill`` the hits topped up from it. ``users`` adds users without interactions.
    """
    seed_rows = materialise(seed_tracks(events, seeds, **columns), "seeds")
    lists = neighbour_lists(seed_rows, tracks, tracks if index is None else index, key, vector, neighbours)
    personal = personal_lists(seed_rows, lists)
    if users is not None:
        everyone = users.select(F.col(users.columns[0]).alias("user")).distinct()
        personal = personal.join(everyone, "user", "full_outer")

    # At most ``limit`` popular tracks can be hits already, so 2 * limit are enough to top up.
    id_type = tracks.schema[key].dataType.simpleString()
    top = [r[0] for r in popular(tracks, 2 * limit if backfill else limit, key, popularity).select(key).collect()]
    listed = F.transform(
        F.array(*[F.lit(i) for i in top]).cast(f"array<{id_type}>"),
        lambda i: F.struct(i.alias("id"), F.lit(None).cast("double").alias("similarity"), F.lit("popular").alias("source")),
    )
    own = F.transform(
        F.slice(F.coalesce("hits", F.array()), 1, limit),
        lambda n: F.struct(n["id"].alias("id"), n["similarity"].alias("similarity"), F.lit("similar").alias("source")),
    )
    if backfill:
        fresh = F.filter(listed, lambda n: ~F.array_contains(F.transform("own", lambda m: m["id"]), n["id"]))
        chosen = F.slice(F.concat("own", fresh), 1, limit)
    else:
        chosen = F.when(F.size("own") >= limit, F.col("own")).otherwise(listed)
    shown = personal.withColumn("own", own).select("user", F.posexplode(chosen).alias("at", "n"))
    return shown.select("user", (F.col("at") + 1).alias("position"), "n.id", "n.similarity", "n.source")


def rule_cluster(columns: Sequence[str], energy: str = "energy", danceability: str = "danceability",
                 key: str = "track_id", threshold: float = 0.6) -> Column:
    """0 for energetic and danceable tracks, else 1; a hash of the key if a feature is no number."""
    parts, unreadable = [], F.lit(False)
    for c in (energy, danceability):
        if c not in columns:
            parts.append(F.lit(0.5))
            continue
        value = F.col(c).try_cast("double")
        unreadable = unreadable | (F.col(c).isNotNull() & value.isNull())
        parts.append(value)
    high = F.coalesce((parts[0] > threshold) & (parts[1] > threshold), F.lit(False))
    return F.when(unreadable, hash_bucket(key).cast("int")).when(high, F.lit(0)).otherwise(F.lit(1))


def browse_clusters(tracks: DataFrame, limit: int = 15, sample: int | None = None, key: str = "track_id",
                    energy: str = "energy", danceability: str = "danceability", threshold: float = 0.6,
                    names: Sequence[str] = CLUSTER_NAMES, seed: int = SEED) -> DataFrame:
    """The first ``limit`` tracks of each rule cluster in seeded order; ``sample`` looks at so many tracks only."""
    picked = tracks if sample is None else seeded_sample(tracks, key, sample, seed)
    label = rule_cluster(tracks.columns, energy, danceability, key, threshold)
    clustered = picked.withColumn("cluster", label)
    order = Window.partitionBy("cluster").orderBy(digest(key, seed), key)
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("cluster") + 1)
    return (
        clustered.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= limit)
        .withColumn("cluster_name", named)
    )


def named_output(hits: DataFrame, tracks: DataFrame, key: str = "track_id", names: Sequence[str] = ("track_name", "title"),
                 artists: Sequence[str] = ("artist_name", "artists"), unknown: str = "Unknown") -> DataFrame:
    """Similar-track rows as shown to users: id, name, artist, similarity, with name fallbacks.

    The hits are stored first: the search runs once, and the planner knows how small they are.
    """
    def first_of(options):
        return F.coalesce(*[F.col(c) for c in options if c in tracks.columns], F.lit(unknown))

    shown = tracks.select(F.col(key).alias("id"), first_of(names).alias("track_name"), first_of(artists).alias("artist_name"))
    return materialise(hits, "hits").join(shown, "id").withColumnRenamed("id", key)
