"""What several test modules share. The name is used in no other folder, so it always resolves here."""

from __future__ import annotations

from datetime import UTC, datetime

BRONZE_CLICK = "id bigint, short_code string, occurred_at timestamp, device_type string, hashed_ip string, user_id double"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
