"""Posts from classification dumps, places, and the post set of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    first_present,
    first_truthy,
    has_media,
    place_type,
    retained,
    safe_cast,
    str_true,
    title_len,
)
from tidemark.vocab import DUMP_EVENT


def valid_dumps(dumps: DataFrame) -> DataFrame:
    """Dump rows of the right event whose payload parses and names a post.

    Adds ``id`` and ``post_alias``, the two spellings of the post id.
    """
    ids = F.from_json("data", "id string, postId string")
    return (
        dumps.filter((F.col("event_name") == DUMP_EVENT) & (F.col("data") != ""))
        .withColumn("_ids", ids)
        .select("data", "date", F.col("_ids.id").alias("id"), F.col("_ids.postId").alias("post_alias"))
    )


def _int(name: str) -> Column:
    return safe_cast(F.col(f"p.{name}"), "int")


def _long(name: str) -> Column:
    return safe_cast(F.col(f"p.{name}"), "bigint")


def _bool(name: str) -> Column:
    return str_true(F.col(f"p.{name}"))


def _coalesced() -> list[Column]:
    p = lambda name: F.col(f"p.{name}")
    duration = first_present(
        safe_cast(p("duration"), "double"), safe_cast(p("media_duration"), "double")
    )
    return [
        first_present(_long("created"), _long("createdAt")).alias("created_ts"),
        p("topic").alias("topic"),
        first_present(p("subTopic"), p("sub_topic")).alias("subTopic"),
        first_present(_int("districtImportanceLevel"), _int("district_score")).alias("distImp"),
        first_present(_int("stateImportanceLevel"), _int("state_score")).alias("stateImp"),
        first_present(_int("nationalImportanceLevel"), _int("national_score")).alias("natImp"),
        first_present(_bool("isLocal"), _bool("is_local")).alias("isLocal"),
        first_present(_bool("isReporter"), _bool("is_reporter")).alias("isReporter"),
        has_media(_bool("containsVisualMedia"), duration).alias("media"),
        duration.alias("media_duration"),
        title_len(p("title"), _int("titleLength")).alias("titleLen"),
        first_present(p("contentLang"), p("lang")).alias("postLang"),
        first_present(p("creatorID"), p("creator_pid"), p("creator_id_alias")).alias("creatorID"),
        first_present(p("location.pid"), p("district_pid"), p("location_pid")).alias("location_pid"),
    ]


def _truthy() -> list[Column]:
    p = lambda name: F.col(f"p.{name}")
    either = lambda a, b, zero: first_truthy(a, b, zero)
    no = F.lit(False)
    duration = safe_cast(p("duration"), "double")
    media_duration = safe_cast(p("media_duration"), "double")
    return [
        either(_long("created"), _long("createdAt"), 0).alias("created_ts"),
        p("topic").alias("topic"),
        either(p("subTopic"), p("sub_topic"), "").alias("subTopic"),
        either(_int("districtImportanceLevel"), _int("district_score"), 0).alias("distImp"),
        either(_int("stateImportanceLevel"), _int("state_score"), 0).alias("stateImp"),
        either(_int("nationalImportanceLevel"), _int("national_score"), 0).alias("natImp"),
        either(_bool("isLocal"), F.coalesce(_bool("is_local"), no), False).alias("isLocal"),
        either(_bool("isReporter"), F.coalesce(_bool("is_reporter"), no), False).alias("isReporter"),
        has_media(_bool("containsVisualMedia"), either(media_duration, duration, 0)).alias("media"),
        either(duration, media_duration, 0).alias("media_duration"),
        either(_int("titleLength"), F.length(F.coalesce(p("title"), F.lit(""))), 0).alias("titleLen"),
        either(p("contentLang"), p("lang"), "").alias("postLang"),
        either(p("creatorID"), either(p("creator_pid"), p("creator_id_alias"), ""), "").alias("creatorID"),
        either(p("location.pid"), either(p("district_pid"), p("location_pid"), ""), "").alias(
            "location_pid"
        ),
    ]


def _strict() -> list[Column]:
    """Coalesced aliases, with media and title taken as written (variant B of the snapshot)."""
    as_written = {
        "media": F.col("p.media").alias("media"),
        "media_duration": _int("duration").alias("media_duration"),
        "titleLen": title_len(F.col("p.title")).alias("titleLen"),
    }
    names = ["created_ts", *schemas.META_COLUMNS]
    return [as_written.get(name, column) for name, column in zip(names, _coalesced(), strict=True)]


_MODES = {"coalesce": _coalesced, "truthy": _truthy, "strict": _strict}


def _post_id(mode: str) -> Column:
    if mode == "strict":
        return F.col("id")
    if mode == "truthy":
        return F.nullif(first_truthy(F.col("id"), F.col("post_alias"), ""), F.lit(""))
    return first_present(F.col("id"), F.col("post_alias"))


def latest_posts(dumps: DataFrame, mode: str = "coalesce") -> DataFrame:
    """One row per post: the newest dump, and of one date the largest payload text.

    The winner is picked as an aggregate, so copies of one post shrink before the shuffle,
    and only winners are parsed in full. ``mode`` says how field aliases combine:
    ``coalesce`` (null falls through), ``truthy`` (0, '' and false fall through too) or
    ``strict`` (coalesced, ``id`` alone names the post, media and title as written).
    """
    winners = (
        valid_dumps(dumps)
        .withColumn("post_id", _post_id(mode))
        .filter(F.col("post_id").isNotNull())
        .groupBy("post_id")
        .agg(F.max(F.struct("date", "data")).alias("w"))
    )
    payload = F.from_json("w.data", schemas.POST_PAYLOAD).cast(schemas.POST_FIELDS)
    parsed = winners.withColumn("p", payload)
    return parsed.select("post_id", *_MODES[mode]())


def posts_from_table(df: DataFrame, since_ms: int | None = None) -> DataFrame:
    """Posts of a document-store table, renamed, with the source-side time predicate."""
    if since_ms is not None:
        df = df.filter(F.col("c") >= since_ms)
    return df.select(
        F.col("id").alias("post_id"),
        F.col("c").alias("created_ts"),
        "topic",
        "subTopic",
        F.col("districtImportanceLevel").alias("distImp"),
        F.col("stateImportanceLevel").alias("stateImp"),
        F.col("nationalImportanceLevel").alias("natImp"),
        "isLocal",
        "isReporter",
        F.col("containsVisualMedia").alias("media"),
        F.col("duration").alias("media_duration"),
        F.col("titleLength").alias("titleLen"),
        F.col("contentLang").alias("postLang"),
        "creatorID",
        F.col("location.pid").alias("location_pid"),
    )


def users_from_table(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("user_id"), "verified", F.col("viewCount").alias("creator_viewcount")
    )


def place_map(places: DataFrame, how: str = "inner") -> DataFrame:
    """District to state. ``left`` keeps districts whose parent is not a known state."""
    own, parent = places.alias("own"), places.alias("parent")
    ty = F.col("parent.ty")
    tree = own.join(parent, (F.col("own.parentId") == F.col("parent.id")) & (ty == "STATE"), how)
    return tree.filter(F.col("own.ty") == "DISTRICT").select(
        F.col("own.id").alias("district_pid"),
        F.col("own.name").alias("district_name"),
        F.col("parent.name").alias("state_name"),
        F.col("own.parentId").alias("state_pid"),
    )


def place_orphans(places: DataFrame) -> DataFrame:
    """Districts with no valid state."""
    states = places.filter(place_type("STATE")).select(F.col("id").alias("parentId"))
    return (
        places.filter(place_type("DISTRICT"))
        .join(states, "parentId", "left_anti")
        .select(
            F.col("id").alias("district_pid"),
            F.col("name").alias("district_name"),
            F.col("parentId").alias("state_pid"),
        )
    )


def with_state(posts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds ``post_state`` from the district map; unknown districts get null.

    The map holds one row per district of the country; Spark broadcasts it when its size
    is below the session's threshold.
    """
    states = mapping.select(
        F.col("district_pid").alias("location_pid"), F.col("state_name").alias("post_state")
    )
    return posts.join(states, "location_pid", "left").select(*posts.columns, "post_state")


def merge_posts(today: DataFrame, previous: DataFrame, cutoff_ms: int) -> DataFrame:
    """Today's posts plus posts of the previous snapshot still inside the window."""
    columns = schemas.POST.fieldNames()
    carried = (
        previous.filter(retained(cutoff_ms))
        .join(today.select("post_id"), "post_id", "left_anti")
        .select(*columns)
    )
    return today.select(*columns).unionByName(carried)


def split_posts(posts: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, existing) by presence in the previous snapshot."""
    known = previous.select("post_id")
    return posts.join(known, "post_id", "left_anti"), posts.join(known, "post_id", "left_semi")
