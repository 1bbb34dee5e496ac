"""Schemas of the text inputs, as DDL strings."""

SUPPLIER = (
    "s_suppkey INT, s_name STRING, s_address STRING, s_nationkey INT, "
    "s_phone STRING, s_acctbal DECIMAL(12,2), s_comment STRING"
)

NATION = "n_nationkey INT, n_name STRING, n_regionkey INT, n_comment STRING"

PART = (
    "p_partkey INT, p_name STRING, p_mfgr STRING, p_brand STRING, p_type STRING, "
    "p_size INT, p_container STRING, p_retailprice DECIMAL(12,2), p_comment STRING"
)

# Dates carry no year in the source, so they stay text.
PLAY_LOG = (
    "event_id INT, game_date STRING, quarter INT, sec_left INT, "
    "away_team STRING, home_team STRING, play_by STRING, "
    "shooter STRING, shot_type STRING, shot_outcome STRING, "
    "assister STRING, blocker STRING, "
    "foul_type STRING, fouler STRING, fouled STRING, "
    "rebounder STRING, rebound_type STRING, "
    "violation_player STRING, violation_type STRING, "
    "free_throw_shooter STRING, free_throw_outcome STRING, "
    "enter_game STRING, leave_game STRING, "
    "turnover_player STRING, turnover_type STRING, turnover_causer STRING"
)

PAIRS = "away_team STRING, home_team STRING"
