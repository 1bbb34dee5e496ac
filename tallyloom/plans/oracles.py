"""The registered queries in SQL, over the same tables.

The strings are written for an independent engine and share no constants with the code
they check. Iterations are recursive: a row holds the state after a step as one list.
"""

from __future__ import annotations

FEATURES = range(9)
RATING_COLUMNS = ("r_away", "r_home", "rot0", "rot1", "rot2", "rot3")

# --- join -------------------------------------------------------------------

SUPPLIERS = """
kept AS (
  SELECT s_nationkey, s_suppkey, min((s_name, s_acctbal)) AS best
  FROM supplier GROUP BY s_nationkey, s_suppkey
), names AS (
  SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY n_nationkey
), joined AS (
  SELECT s_suppkey, best[1] AS s_name, best[2] AS s_acctbal, n_name
  FROM kept JOIN names ON s_nationkey = n_nationkey
)
"""

JOIN = {
    "supplier_nation_join": f"WITH {SUPPLIERS} SELECT * FROM joined ORDER BY s_suppkey",
    "supplier_nation_tagged_union": """
SELECT 'supplier' AS source_table, s_nationkey AS nation_key, s_suppkey AS supplier_key,
       s_name AS supplier_name, s_acctbal, NULL::VARCHAR AS nation_name
FROM supplier
UNION ALL
SELECT 'nation', n_nationkey, NULL, NULL, NULL, n_name FROM nation
""",
    "supplier_partition_sort": f"""
WITH {SUPPLIERS}
SELECT *, CAST(s_suppkey % 4 AS INTEGER) AS part_id FROM joined ORDER BY part_id, s_suppkey
""",
    "supplier_lines": f"""
WITH {SUPPLIERS}
SELECT s_suppkey || '|' || s_name || '|' || CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS VARCHAR) || '|' || n_name AS line
FROM joined
""",
}

# --- text index -------------------------------------------------------------

COUNTS = r"""
tokens AS (
  SELECT doc_id AS doc, unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents
), counts AS (
  SELECT word, doc, count(*) AS tf FROM tokens WHERE word <> '' GROUP BY word, doc
), averages AS (
  SELECT word, CAST(sum(tf) AS BIGINT) AS total, count(*) AS documents,
         CAST((200 * sum(tf) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average
  FROM counts GROUP BY word
), postings AS (
  SELECT word, CAST(doc // 100000 AS BIGINT) AS line_no, any_value(documents) AS documents,
         any_value(average) AS average, string_agg(doc || ':' || tf, '; ' ORDER BY doc) AS postings
  FROM counts JOIN (SELECT word, documents, average FROM averages) USING (word) GROUP BY word, line_no
)
"""

TEXT = {
    "word_occurrences": f"WITH {COUNTS} SELECT doc, count(*) AS words FROM tokens WHERE word <> '' GROUP BY doc",
    "term_document_counts": f"WITH {COUNTS} SELECT word, doc, tf FROM counts",
    "whole_document_counts": f"WITH {COUNTS} SELECT word, doc, tf FROM counts",
    "term_average_frequency": f"WITH {COUNTS} SELECT word, total, documents, average FROM averages",
    "inverted_index_postings": f"WITH {COUNTS} SELECT * FROM postings",
    "inverted_index_lines": f"""
WITH {COUNTS} SELECT word, printf('%.2f', average) || ', ' || postings AS value FROM postings
""",
    "words_by_frequency_asc": f"WITH {COUNTS} SELECT word, average FROM averages ORDER BY average, word",
    "words_by_frequency_desc": f"WITH {COUNTS} SELECT word, average FROM averages ORDER BY average DESC, word",
}

# --- play log ---------------------------------------------------------------

PLAYS = """
numbered AS (
  SELECT *, (day(ts) * 3 + (event_id % 5) * 2) % 10 AS home_no FROM events
), sided AS (
  SELECT *, 'team' || home_no AS home_team,
         'team' || ((home_no + 1 + 2 * ((day(ts) + event_id % 5) % 3)) % 10) AS away_team,
         event_type IN ('click', 'purchase') AS shot, value >= 40 AS on_target
  FROM numbered
), plays AS (
  SELECT event_id, CAST(ts AS DATE) AS game_date, home_team, away_team,
    CASE WHEN user_id % 2 = 0 THEN home_team ELSE away_team END AS play_by,
    CASE WHEN shot THEN 'p' || user_id END AS shooter,
    CASE event_type WHEN 'click' THEN '2-pt jump shot' WHEN 'purchase' THEN '3-pt jump shot' END AS shot_type,
    CASE WHEN shot AND on_target THEN 'make' WHEN shot THEN 'miss' END AS shot_outcome,
    CASE WHEN shot AND on_target AND event_id % 3 = 0 THEN 'p' || (user_id + 2) % 150 END AS assister,
    CASE WHEN shot AND NOT on_target AND event_id % 4 = 0 THEN 'p' || (user_id + 1) % 150 END AS blocker,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 1
         THEN CASE WHEN event_id % 2 = 0 THEN 'offensive' ELSE 'shooting' END END AS foul_type,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'p' || user_id END AS rebounder,
    CASE WHEN event_type = 'view' THEN 'p' || user_id END AS free_throw_shooter,
    CASE WHEN event_type = 'view' AND value >= 20 THEN 'make' WHEN event_type = 'view' THEN 'miss' END
      AS free_throw_outcome,
    CASE WHEN event_type = 'signup' AND event_id % 3 = 2 THEN 'p' || user_id END AS enter_game,
    CASE WHEN event_type = 'error' THEN 'bad pass' END AS turnover_type,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'p' || (user_id + 1) % 150 END AS turnover_causer
  FROM sided
), labels_per_event AS (
  SELECT event_id, play_by,
    CASE WHEN free_throw_outcome = 'make' THEN 1
         WHEN shot_outcome = 'make' THEN CAST(shot_type[1] AS INTEGER) END AS points
  FROM plays
), scores AS (
  SELECT game_date, home_team,
    CAST(sum(CASE WHEN play_by = home_team THEN points ELSE 0 END) AS BIGINT) AS home_score, away_team,
    CAST(sum(CASE WHEN play_by = home_team THEN 0 ELSE points END) AS BIGINT) AS away_score
  FROM (
    SELECT *, CASE WHEN shot_type IS NULL OR shot_outcome = 'miss' THEN 0
                   WHEN shot_type LIKE '2%' THEN 2 ELSE 3 END
              + CASE WHEN free_throw_outcome = 'make' THEN 1 ELSE 0 END AS points
    FROM plays WHERE shot_type IS NOT NULL OR free_throw_outcome = 'make')
  GROUP BY game_date, home_team, away_team
), facts AS (
  SELECT 'score' AS stat,
    CASE WHEN free_throw_outcome = 'make' THEN coalesce(free_throw_shooter, shooter) ELSE shooter END AS player,
    CASE WHEN free_throw_outcome = 'make' THEN 1 ELSE CAST(shot_type[1] AS INTEGER) END AS n
  FROM plays WHERE free_throw_outcome = 'make' OR shot_outcome = 'make'
  UNION ALL SELECT 'rebound', rebounder, 1 FROM plays
  UNION ALL SELECT 'assist', assister, 1 FROM plays
  UNION ALL SELECT 'steal', turnover_causer, 1 FROM plays
  UNION ALL SELECT 'block', blocker, 1 FROM plays
), totals AS (
  SELECT stat, player, CAST(sum(n) AS BIGINT) AS n FROM facts WHERE player IS NOT NULL GROUP BY stat, player
), top5 AS (
  SELECT stat, CAST(dense_rank() OVER (PARTITION BY stat ORDER BY n DESC) AS INTEGER) AS rank, player, n
  FROM totals
  QUALIFY row_number() OVER (PARTITION BY stat ORDER BY n DESC, player) <= 5
), shares AS (
  SELECT away_team, home_team, count(*) AS matches,
    count(*) FILTER (WHERE away_score > home_score) AS away_wins
  FROM scores GROUP BY away_team, home_team
)
"""


def _side(name: str, acts: str, opposes: str) -> str:
    fouls = "'offensive', 'loose ball'"
    own = f"foul_type IN ({fouls})"

    def count(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def rate(acting: str, made: str) -> str:
        attempts = count(f"{acts} AND {acting}")
        hits = count(f"{acts} AND {acting} AND {made}")
        return f"coalesce(CAST({hits} AS DOUBLE) / nullif({attempts}, 0), 0)"

    values = [
        rate("shooter IS NOT NULL AND shot_type LIKE '2%'", "shot_outcome = 'make'"),
        rate("shooter IS NOT NULL AND shot_type NOT LIKE '2%'", "shot_outcome = 'make'"),
        count(f"{acts} AND assister IS NOT NULL"),
        count(f"{opposes} AND blocker IS NOT NULL"),
        count(f"({acts} AND {own}) OR ({opposes} AND foul_type IS NOT NULL AND NOT {own})"),
        rate("free_throw_outcome IS NOT NULL", "free_throw_outcome = 'make'"),
        count(f"{opposes} AND turnover_type IS NOT NULL"),
        count(f"{acts} AND turnover_type IS NOT NULL"),
        count(f"{acts} AND enter_game IS NOT NULL"),
    ]
    score = (
        f"coalesce(sum(CASE WHEN shot_outcome = 'make' THEN CAST(shot_type[1] AS INTEGER) "
        f"WHEN free_throw_outcome = 'make' THEN 1 ELSE 0 END) FILTER (WHERE {acts}), 0)"
    )
    return ",\n    ".join(
        [f"CAST({score} AS BIGINT) AS {name}_score"]
        + [f"CAST({v} AS DOUBLE) AS {name}_r{i}" for i, v in enumerate(values)]
    )


MATCHES = f"""
{PLAYS.strip()}, matches AS (
  SELECT game_date, home_team, away_team,
    {_side("away", "play_by <> home_team", "play_by = home_team")},
    {_side("home", "play_by = home_team", "play_by <> home_team")}
  FROM plays
  WHERE coalesce(shooter, assister, blocker, foul_type, free_throw_outcome, turnover_type, enter_game) IS NOT NULL
  GROUP BY game_date, home_team, away_team
), team_rows AS (
  SELECT away_team AS team, {", ".join(f"away_r{i} AS r{i}" for i in FEATURES)} FROM matches
  UNION ALL
  SELECT home_team, {", ".join(f"home_r{i}" for i in FEATURES)} FROM matches
), profiles AS (
  SELECT team, {", ".join(f"avg(r{i}) AS r{i}" for i in FEATURES)} FROM team_rows GROUP BY team
)
"""

# Display names of the player statistics.
STAT_CASE = (
    "CASE stat WHEN 'score' THEN '得分' WHEN 'rebound' THEN '篮板' WHEN 'assist' THEN '助攻' "
    "WHEN 'steal' THEN '抢断' WHEN 'block' THEN '盖帽' END"
)


def _four(part: str) -> str:
    return f"printf('%.4f', CAST((20000 * ({part}) + matches) // (2 * matches) AS DOUBLE) / 10000)"


PLAYLOG = {
    "event_outcome_label": f"WITH {PLAYS} SELECT * FROM labels_per_event",
    "event_outcome_lines": f"""
WITH {PLAYS}
SELECT event_id, event_id || ',' || CASE WHEN points IS NULL THEN '不得分'
                                         ELSE play_by || ' 得 ' || points || ' 分' END AS label_line
FROM labels_per_event ORDER BY label_line
""",
    "match_scores": f"WITH {PLAYS} SELECT * FROM scores ORDER BY game_date, home_team, away_team",
    "match_score_lines": f"""
WITH {PLAYS}
SELECT concat_ws(',', game_date, home_team, home_score, away_team, away_score) AS line FROM scores
""",
    "player_stat_totals": f"WITH {PLAYS} SELECT * FROM totals",
    "leaderboard_top5": f"WITH {PLAYS} SELECT * FROM top5",
    "leaderboard_distinct_top5": f"""
WITH {PLAYS}
SELECT stat, CAST(row_number() OVER (PARTITION BY stat ORDER BY n DESC) AS INTEGER) AS rank, player, n
FROM (SELECT stat, n, min(player) AS player FROM totals GROUP BY stat, n)
QUALIFY row_number() OVER (PARTITION BY stat ORDER BY n DESC) <= 5
""",
    "leaderboard_lines": f"""
WITH {PLAYS} SELECT concat_ws(',', {STAT_CASE}, rank, player, n) AS line FROM top5
""",
    "head_to_head_share": f"""
WITH {PLAYS}
SELECT *, CAST(away_wins AS DOUBLE) / matches AS p_away,
       1 - CAST(away_wins AS DOUBLE) / matches AS p_home
FROM shares
""",
    "head_to_head_lines": f"""
WITH {PLAYS}
SELECT away_team || ',' || {_four("away_wins")} || ',' || home_team || ',' || {_four("matches - away_wins")}
       AS line
FROM shares
""",
    "match_features": f"WITH {MATCHES} SELECT * FROM matches",
    "match_profile_lines": f"""
WITH {MATCHES}
SELECT concat_ws(':', away_team, concat_ws(',', away_score, {", ".join(f"away_r{i}" for i in FEATURES)}))
       || ';' ||
       concat_ws(':', home_team, concat_ws(',', home_score, {", ".join(f"home_r{i}" for i in FEATURES)})) AS line
FROM matches
""",
    "team_profiles": f"""
WITH {MATCHES} SELECT team, {", ".join(f"round(r{i}, 6) + 0.0 AS r{i}" for i in FEATURES)} FROM profiles
""",
}
# The lines hold every number in full, so reading them again changes nothing.
PLAYLOG["team_profiles_from_lines"] = PLAYLOG["team_profiles"]

# --- clustering -------------------------------------------------------------

# Vectors with a null or NaN coordinate take no part.
STEPS = """
usable AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0
), coordinates AS MATERIALIZED (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM usable
), start_ids AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS cluster FROM usable ORDER BY vec_id LIMIT 10
), steps AS (
  SELECT 0 AS step, list({'cluster': cluster, 'dim': dim, 'value': x}) AS centers, CAST(NULL AS DOUBLE) AS shift
  FROM coordinates JOIN start_ids USING (vec_id)
  UNION ALL
  SELECT step + 1, list({'cluster': cluster, 'dim': dim, 'value': moved}), sum((moved - value) * (moved - value))
  FROM (
    SELECT old.step, old.cluster, old.dim, old.value, coalesce(new.value, old.value) AS moved
    FROM (
      SELECT step, c.cluster AS cluster, c.dim AS dim, c.value AS value
      FROM (SELECT step, unnest(centers) AS c FROM steps WHERE shift IS NULL OR shift >= 0.001)
    ) old LEFT JOIN (
      SELECT cluster, dim, avg(x) AS value FROM coordinates JOIN (
        SELECT vec_id, cluster FROM (
          SELECT vec_id, c.cluster AS cluster, sum((x - c.value) * (x - c.value)) AS distance
          FROM coordinates JOIN (
            SELECT unnest(centers) AS c FROM steps WHERE shift IS NULL OR shift >= 0.001
          ) ON dim = c.dim GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
      ) USING (vec_id) GROUP BY cluster, dim
    ) new ON old.cluster = new.cluster AND old.dim = new.dim
  ) GROUP BY step
), center AS MATERIALIZED (
  SELECT step, c.cluster AS cluster, c.dim AS dim, c.value AS value FROM (SELECT step, unnest(centers) AS c FROM steps)
)
"""


def _centers_out(step: str) -> str:
    return (
        f"WITH RECURSIVE {STEPS} SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, "
        f"round(value, 6) + 0.0 AS value FROM center WHERE step = {step}"
    )


def _assigned_out(step: str) -> str:
    return f"""
WITH RECURSIVE {STEPS}, assigned AS (
  SELECT vec_id, cluster FROM (
    SELECT vec_id, cluster, sum((x - value) * (x - value)) AS distance
    FROM coordinates JOIN (SELECT * FROM center WHERE step = {step}) USING (dim) GROUP BY vec_id, cluster)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)
SELECT vec_id, label, CAST(cluster AS INTEGER) AS cluster FROM embeddings LEFT JOIN assigned USING (vec_id)
"""


_LAST = "(SELECT max(step) FROM steps)"

CLUSTERING = {
    "kmeans_assign": _assigned_out("0"),
    "kmeans_step": _centers_out("1"),
    "kmeans_fit": _centers_out(_LAST),
    "kmeans_bounded_fit": _centers_out(_LAST),
    "kmeans_shift_by_step": f"WITH RECURSIVE {STEPS} SELECT CAST(step AS INTEGER) AS step, "
    "round(shift, 6) + 0.0 AS shift FROM steps WHERE step > 0",
    "kmeans_final_assign": _assigned_out(_LAST),
}

# --- win model --------------------------------------------------------------


def _model_rounds() -> str:
    """Weights after each round as one list: 9 away, 9 home, then 81 products; until the mean loss settles."""

    def scaled(prefix: str, i: int) -> str:
        return f"({prefix}r{i} - m{i}) / s{i}"

    inputs = (
        [f"a{i}" for i in FEATURES]
        + [f"-h{i}" for i in FEATURES]
        + [f"a{i} * h{j}" for i in FEATURES for j in FEATURES]
    )
    size = len(inputs)
    parts = [
        MATCHES.strip(),
        "scales AS MATERIALIZED (SELECT "
        + ", ".join(
            f"avg(r{i}) AS m{i}, coalesce(nullif(stddev_pop(r{i}), 0), 1) AS s{i}" for i in FEATURES
        )
        + " FROM team_rows)",
        "scaled AS (SELECT CASE WHEN away_score > home_score THEN 1.0::DOUBLE ELSE 0.0 END AS won, "
        + ", ".join(f"{scaled('away_', i)} AS a{i}, {scaled('home_', i)} AS h{i}" for i in FEATURES)
        + " FROM matches, scales)",
        f"inputs AS MATERIALIZED (SELECT won, [{', '.join(inputs)}] AS x FROM scaled)",
        f"""model AS (
  SELECT 0 AS round, list_transform(range({size}), lambda i: 0.0::DOUBLE) AS w,
         CAST(NULL AS DOUBLE) AS loss, CAST(NULL AS DOUBLE) AS change
  UNION ALL
  SELECT round + 1, list(value ORDER BY i), any_value(new_loss), any_value(abs(new_loss - loss))
  FROM (
    SELECT round, loss, i, any_value(w[i]) + 0.5 * avg((won - 1 / (1 + exp(-z))) * x[i]) AS value,
           avg(ln(1 + exp(z)) - won * z) AS new_loss
    FROM (
      SELECT round, loss, w, x, won, list_dot_product(x, w) AS z
      FROM inputs, (SELECT * FROM model WHERE change IS NULL OR change >= 0.001)
    ), range(1, {size + 1}) AS positions(i)
    GROUP BY round, loss, i
  ) GROUP BY round, loss
)""",
        "weights AS (SELECT w FROM model ORDER BY round DESC LIMIT 1)",
    ]
    return ", ".join(parts)


def _profile_lists() -> str:
    """Team profiles as model inputs, and the model's logit per pair of teams."""
    away = ", ".join(f"(a.r{i} - m{i}) / s{i}" for i in FEATURES)
    home = ", ".join(f"(h.r{i} - m{i}) / s{i}" for i in FEATURES)
    cross = ", ".join(f"pa[{i + 1}] * ph[{j + 1}]" for i in FEATURES for j in FEATURES)
    negative = ", ".join(f"-ph[{i + 1}]" for i in FEATURES)
    return f"""all_pairs AS (
  SELECT a.team AS away_team, h.team AS home_team, [{away}] AS pa, [{home}] AS ph
  FROM profiles a, profiles h, scales
), kernels AS MATERIALIZED (
  SELECT away_team, home_team,
         list_dot_product(list_concat(pa, [{negative}], [{cross}]), w) AS kernel
  FROM all_pairs, weights
)"""


def _probability(ratio: str) -> str:
    return (
        f"1 / (1 + exp(-(kernel * {ratio} + a.r_away - h.r_home"
        " + a.rot0 * h.rot1 - a.rot1 * h.rot0 + a.rot2 * h.rot3 - a.rot3 * h.rot2)))"
    )


def _rating_rounds() -> str:
    """Ratings after each round as one list of teams; until no rating changes much."""
    state = "{'team': team, 'matches': matches, " + ", ".join(f"'{c}': {c}" for c in RATING_COLUMNS) + "}"
    moved = "{'team': team, 'matches': matches, " + ", ".join(f"'{c}': new_{c}" for c in RATING_COLUMNS) + "}"
    unpacked = ", ".join(f"t.{c} AS {c}" for c in ("team", "matches", *RATING_COLUMNS))
    parts = [
        _model_rounds(),
        _profile_lists(),
        """pairs AS MATERIALIZED (
  SELECT away_team, home_team, n, wins, kernel FROM (
    SELECT away_team, home_team, count(*) AS n, count(*) FILTER (WHERE away_score > home_score) AS wins
    FROM matches GROUP BY away_team, home_team) JOIN kernels USING (away_team, home_team)
)""",
        f"""ratings AS (
  SELECT 0 AS round, list({state}) AS teams, 1.0::DOUBLE AS ratio, CAST(NULL AS DOUBLE) AS change
  FROM (SELECT team, count(*) AS matches, 0.0::DOUBLE AS r_away, 0.0::DOUBLE AS r_home,
               1.0::DOUBLE AS rot0, 1.0::DOUBLE AS rot1, 1.0::DOUBLE AS rot2, 1.0::DOUBLE AS rot3
        FROM team_rows GROUP BY team)
  UNION ALL
  SELECT any_value(round) + 1, list({moved}), any_value(new_ratio),
         max(greatest({", ".join(f"abs(new_{c} - {c})" for c in RATING_COLUMNS)}))
  FROM (
    WITH current AS (SELECT * FROM ratings WHERE change IS NULL OR change >= 0.02),
    old AS (SELECT round, ratio, {unpacked} FROM (SELECT round, ratio, unnest(teams) AS t FROM current)),
    rated AS (
      SELECT away_team, home_team, n, kernel, wins - n * ({_probability("a.ratio")}) AS residual,
             a.ratio AS ratio, a.matches AS am, h.matches AS hm,
             {", ".join(f"a.rot{i} AS a{i}, h.rot{i} AS h{i}" for i in range(4))}
      FROM pairs JOIN old a ON a.team = away_team JOIN old h ON h.team = home_team
    ), changes AS (
      SELECT away_team AS team, residual / am AS r_away, 0 AS r_home,
             residual / am * h1 AS rot0, -residual / am * h0 AS rot1,
             residual / am * h3 AS rot2, -residual / am * h2 AS rot3
      FROM rated
      UNION ALL
      SELECT home_team, 0, -residual / hm, -residual / hm * a1, residual / hm * a0,
             -residual / hm * a3, residual / hm * a2
      FROM rated
    ), summed AS (
      SELECT team, {", ".join(f"sum({c}) AS {c}" for c in RATING_COLUMNS)} FROM changes GROUP BY team
    )
    SELECT old.round, old.team, old.matches, {", ".join(f"old.{c}" for c in RATING_COLUMNS)},
           {", ".join(f"old.{c} + coalesce(summed.{c}, 0) AS new_{c}" for c in RATING_COLUMNS)},
           old.ratio + (SELECT sum(residual * kernel) / sum(n) FROM rated) AS new_ratio
    FROM old LEFT JOIN summed ON old.team = summed.team
  ) HAVING count(*) > 0
)""",
        f"""final AS MATERIALIZED (
  SELECT ratio, {unpacked}
  FROM (SELECT ratio, unnest(teams) AS t FROM (SELECT * FROM ratings ORDER BY round DESC LIMIT 1))
)""",
    ]
    return ", ".join(parts)


def _ratings_by_date() -> str:
    """Ratings after each date as one list of teams; all matches of a date against the ratings before it."""
    state = "{'team': team, 'matches': matches, " + ", ".join(f"'{c}': {c}" for c in RATING_COLUMNS) + "}"
    moved = "{'team': team, 'matches': matches, " + ", ".join(f"'{c}': new_{c}" for c in RATING_COLUMNS) + "}"
    unpacked = ", ".join(f"t.{c} AS {c}" for c in ("team", "matches", *RATING_COLUMNS))
    parts = [
        _model_rounds(),
        _profile_lists(),
        """played AS MATERIALIZED (
  SELECT dense_rank() OVER (ORDER BY game_date) AS day, away_team, home_team, n, wins, kernel FROM (
    SELECT game_date, away_team, home_team, count(*) AS n, count(*) FILTER (WHERE away_score > home_score) AS wins
    FROM matches GROUP BY ALL) JOIN kernels USING (away_team, home_team)
)""",
        f"""dated AS (
  SELECT 0 AS day, list({state}) AS teams
  FROM (SELECT team, count(*) AS matches, 0.0::DOUBLE AS r_away, 0.0::DOUBLE AS r_home,
               1.0::DOUBLE AS rot0, 1.0::DOUBLE AS rot1, 1.0::DOUBLE AS rot2, 1.0::DOUBLE AS rot3
        FROM team_rows GROUP BY team)
  UNION ALL
  SELECT any_value(day) + 1, list({moved})
  FROM (
    WITH current AS (SELECT * FROM dated WHERE day < (SELECT max(day) FROM played)),
    old AS (SELECT day, {unpacked} FROM (SELECT day, unnest(teams) AS t FROM current)),
    rated AS (
      SELECT away_team, home_team, 0.1 * (wins - n * ({_probability("1.0")})) AS residual,
             {", ".join(f"a.rot{i} AS a{i}, h.rot{i} AS h{i}" for i in range(4))}
      FROM played JOIN old a ON a.team = away_team AND played.day = a.day + 1 JOIN old h ON h.team = home_team
    ), changes AS (
      SELECT away_team AS team, residual AS r_away, 0 AS r_home,
             residual * h1 AS rot0, -residual * h0 AS rot1, residual * h3 AS rot2, -residual * h2 AS rot3
      FROM rated
      UNION ALL
      SELECT home_team, 0, -residual, -residual * a1, residual * a0, -residual * a3, residual * a2
      FROM rated
    ), summed AS (
      SELECT team, {", ".join(f"sum({c}) AS {c}" for c in RATING_COLUMNS)} FROM changes GROUP BY team
    )
    SELECT old.day, old.team, old.matches,
           {", ".join(f"old.{c} + coalesce(summed.{c}, 0) AS new_{c}" for c in RATING_COLUMNS)}
    FROM old LEFT JOIN summed ON old.team = summed.team
  ) HAVING count(*) > 0
)""",
        f"""last_day AS (
  SELECT {unpacked} FROM (SELECT unnest(teams) AS t FROM (SELECT * FROM dated ORDER BY day DESC LIMIT 1))
)""",
    ]
    return ", ".join(parts)


def _weight_rows() -> str:
    rows = (
        [("away", i, -1) for i in FEATURES]
        + [("home", i, -1) for i in FEATURES]
        + [("cross", i, j) for i in FEATURES for j in FEATURES]
    )
    values = ", ".join(f"({n}, '{p}', {i}, {j})" for n, (p, i, j) in enumerate(rows, start=1))
    return f"""SELECT part, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(w[n], 6) + 0.0 AS weight
FROM weights, (VALUES {values}) AS slots(n, part, i, j)"""


WIN_MODEL = {
    "win_model_fit": f"WITH RECURSIVE {_model_rounds()} {_weight_rows()}",
    "team_ratings_fit": f"""
WITH RECURSIVE {_rating_rounds()}
SELECT team, matches, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in RATING_COLUMNS)},
       round(ratio, 6) + 0.0 AS ratio
FROM final
""",
    "team_ratings_in_order": f"""
WITH RECURSIVE {_ratings_by_date()}
SELECT team, matches, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in RATING_COLUMNS)} FROM last_day
""",
    "predict_pairs": f"""
WITH RECURSIVE {_rating_rounds()}
SELECT s.away_team, s.home_team, round({_probability("a.ratio")}, 6) + 0.0 AS p_away
FROM (SELECT DISTINCT home_team AS away_team, away_team AS home_team FROM matches) s
JOIN kernels USING (away_team, home_team)
JOIN final a ON a.team = s.away_team
JOIN final h ON h.team = s.home_team
""",
}

ORACLES: dict[str, str] = {**JOIN, **TEXT, **PLAYLOG, **CLUSTERING, **WIN_MODEL}
