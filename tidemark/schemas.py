"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _L, _I, _D, _B = StringType(), LongType(), IntegerType(), DoubleType(), BooleanType()

EVENT_LOG = _struct(
    event_id=_S, event_time=_L, data=_S, platform=_S, user_id=_S, event_name=_S, date=_S
)

DUMP_LOG = _struct(event_name=_S, data=_S, date=_S)

# Payload scalars stay text: the app writes numbers and booleans both quoted and bare,
# and a typed JSON field would turn one of the two spellings into null.
EVENT_PAYLOAD = _struct(
    postId=_S,
    userAge=_S,
    isLocked=_S,
    isInitiatedFromPost=_S,
    origin=_S,
    duration=_S,
    postEngagement=_struct(mediaClicked=_S, readModeOpen=_S, screenTime=_S),
    maxListenDuration=_S,
    districtId=_S,
    stateId=_S,
)

POST_PAYLOAD = _struct(
    id=_S,
    postId=_S,
    created=_S,
    createdAt=_S,
    topic=_S,
    subTopic=_S,
    sub_topic=_S,
    districtImportanceLevel=_S,
    district_score=_S,
    stateImportanceLevel=_S,
    state_score=_S,
    nationalImportanceLevel=_S,
    national_score=_S,
    isLocal=_S,
    is_local=_S,
    isReporter=_S,
    is_reporter=_S,
    containsVisualMedia=_S,
    media=_S,
    duration=_S,
    media_duration=_S,
    titleLength=_S,
    title=_S,
    contentLang=_S,
    lang=_S,
    creatorID=_S,
    creator_pid=_S,
    creatorId=_S,
    location=_struct(pid=_S),
    district_pid=_S,
    location_pid=_S,
)

# Two spellings of the creator differ in case alone, which column names cannot. Struct casts
# go by position, so a cast to this type gives the second one a name of its own.
POST_FIELDS = StructType(
    [
        StructField("creator_id_alias" if f.name == "creatorId" else f.name, f.dataType)
        for f in POST_PAYLOAD.fields
    ]
)

PLACE = _struct(id=_S, ty=_S, name=_S, parentId=_S)
PLACE_ENTRY = _struct(district_name=_S, state_name=_S, state_pid=_S)
PLACE_OBJECT = MapType(_S, PLACE_ENTRY)
PLACE_MAP = _struct(district_pid=_S, district_name=_S, state_name=_S, state_pid=_S)

_META = dict(
    topic=_S,
    subTopic=_S,
    distImp=_I,
    stateImp=_I,
    natImp=_I,
    isLocal=_B,
    isReporter=_B,
    media=_B,
    media_duration=_D,
    titleLen=_I,
    postLang=_S,
    creatorID=_S,
    location_pid=_S,
)

POST = _struct(post_id=_S, created_ts=_L, **_META)

# Counters are 64-bit: fan-out counts are products and outgrow 32 bits.
_ENGAGEMENT = dict(
    views=_L,
    shareCount=_L,
    mediaClickedCount=_L,
    reactionCount=_L,
    commentCount=_L,
    readModeCount=_L,
    avgDur=_D,
    listenpct=_D,
)
_CONVERSION = dict(
    post_locks_so_far=_L,
    post_initiates_so_far=_L,
    post_trials_so_far=_L,
    post_day0_locks=_L,
    post_day0_initiates=_L,
    post_day0_trials=_L,
)
_RATES = dict(
    post_day0_initiates_per_view=_D,
    post_day0_trials_per_view=_D,
    post_day0_initiates_per_lock=_D,
)

SNAPSHOT = _struct(
    run_ts=_L,
    post_id=_S,
    created_ts=_L,
    **_ENGAGEMENT,
    **_META,
    post_state=_S,
    **_CONVERSION,
    **_RATES,
)

SNAPSHOT_B = _struct(
    post_id=_S,
    created_ts=_L,
    topic=_S,
    subTopic=_S,
    classified=_I,
    distImp=_I,
    stateImp=_I,
    natImp=_I,
    isLocal=_B,
    isReporter=_B,
    media=_S,
    media_duration=_I,
    titleLen=_I,
    postLang=_S,
    creatorID=_S,
    location_pid=_S,
    age_hours=_D,
    **_ENGAGEMENT,
    **_CONVERSION,
    **_RATES,
    snapshot_ts=_L,
)

LABELS = _struct(user_id=_S, post_id=_S, run_ts=_L, view_time=_L, y=_I, date=_S)

FEATURES = {
    "eco_district": _struct(
        district_pid=_S,
        district_posts_7d=_L,
        district_reporters_7d=_L,
        district_users_7d=_L,
        date=_S,
    ),
    "eco_state": _struct(state_name=_S, state_posts_7d=_L, state_reporters_7d=_L, date=_S),
    "eco_lang": _struct(postLang=_S, lang_posts_7d=_L, lang_reporters_7d=_L, date=_S),
    "creator": _struct(
        creatorID=_S,
        creator_prior_rate=_D,
        creator_has_prior=_I,
        creator_viewcount=_L,
        creator_verified=_B,
        date=_S,
    ),
}

SNAPSHOT_COLUMNS = SNAPSHOT.fieldNames()
SNAPSHOT_B_COLUMNS = SNAPSHOT_B.fieldNames()
ENGAGEMENT_COLUMNS = list(_ENGAGEMENT)
CONVERSION_COLUMNS = list(_CONVERSION)
RATE_COLUMNS = list(_RATES)
META_COLUMNS = list(_META)
