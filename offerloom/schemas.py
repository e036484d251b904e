"""Schemas of stored tables and messages, as DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The decision log, column by column.
DECISION_LOG = (
    "app string, implementation string, id string, id_type string, enterprise_id string, time timestamp, t string, "
    "eps_id string, agent_index int, obs array<double>, actions array<int>, action_prob double, action_logp double, "
    "logits array<double>, q_values array<double>, probs array<double>, mask array<int>, rewards double, "
    "prev_actions array<int>, prev_rewards double, dones int, infos string, new_obs array<double>, "
    "raw_state array<string>, raw_state_str array<string>, raw_action_str array<string>"
)

# Fact tables.
DISPOSITION_FACT = (
    "enterprise_id bigint, organization string, app string, source string, category string, date date, "
    "date_time timestamp, offer string, offered int, accepted int, success int, failure int"
)
REWARD_FACT = (
    "enterprise_id bigint, organization string, app string, source string, category string, date date, "
    "date_time timestamp, reward_name string, reward_desc string, reward_value int"
)

VOCABULARY = "token_name string, token int"
STATE = (
    "enterprise_id bigint, date date, state array<string>, state_tokenized array<int>, size int, cum_size bigint, "
    "current_record int"
)
SESSION_MESSAGE = "session string, time timestamp, action int, reward double, done int"


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, with the names, when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
