"""Attempts, dead letters and their replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: receives before a message becomes a dead letter.
MAX_RECEIVES = 5


def split_attempts(failed: DataFrame, max_receives: int = MAX_RECEIVES) -> tuple[DataFrame, DataFrame]:
    """Failed messages to try again, and dead ones."""
    spent = F.col("receive_count") >= max_receives
    return failed.where(~spent), failed.where(spent)


def dead_messages(parsed: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """Whole dead messages, ready for replay."""
    failed = parsed.where(F.col("failure_reason").isNotNull())
    return split_attempts(failed, max_receives)[1]


def replay_candidates(dead: DataFrame, limit: int) -> DataFrame:
    """The oldest dead letters; what lies beyond the limit stays."""
    return dead.orderBy("sent_at", "message_id").limit(limit)


def replay(dead: DataFrame, input_path: str, limit: int, dry_run: bool = False, replay_id: str = "replay-1") -> DataFrame:
    """Append dead letters to the stream's input folder and return them; a dry run only returns them.

    A replayed letter is a new message: its id carries ``replay_id``, its receive count starts over and it is sent now,
    so the stream handles it like any other.  The same ``replay_id`` again gives the same ids, which the stream handles
    once; a letter without id gets one from its ``delivery_key``.  The caller drops replayed letters from the dead-letter
    table (left anti join on the key) once the write has succeeded, so a failed write leaves them in place.
    """
    chosen = replay_candidates(dead, limit)
    if not dry_run:
        own = F.coalesce("message_id", "delivery_key") if "delivery_key" in chosen.columns else F.col("message_id")
        renamed = F.concat(own, F.lit(f"/{replay_id}")).alias("message_id")
        rows = chosen.select(renamed, "queue_url", "stream", "body", F.lit(1).alias("receive_count"), F.current_timestamp().alias("sent_at"))
        rows.write.mode("append").json(input_path)
    return chosen
