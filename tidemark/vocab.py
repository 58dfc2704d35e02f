"""Event names. Two generations of the app log use different words for the same thing."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    reaction: str
    comment: str
    trial: str
    first_call: str = "feed_first_call"
    locked: str = "feed_locked"
    initiate: str = "initiate_transaction"
    shared: str = "post_shared"
    media_click: str = "media_clicked"
    read_mode: str = "read_mode_entered"
    seen: str = "post_seen"


# Event names as written by the app.
VOCAB_A = Vocabulary(
    reaction="post_reaction",
    comment="comment_created",
    trial="subscription_trial_started",
)
VOCAB_B = Vocabulary(
    reaction="post_reacted",
    comment="comment_posted",
    trial="trial_payment_success",
)

DUMP_EVENT = "post_classification_data_dump"
