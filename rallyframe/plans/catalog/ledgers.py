"""Form, settlement and running totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.operators import form as W
from rallyframe.operators import ledgers as L
from rallyframe.operators import merging as M
from rallyframe.plans import views
from rallyframe.plans.catalog.functions import SETTLE_STATUS, score_array
from rallyframe.plans.registry import query

AS_OF = "2024-01-25"


def scored(spark, sf):
    return views.matches(spark, sf).withColumn("scores", score_array())


def form(spark, sf):
    return W.form_last_n(W.played_sides(scored(spark, sf)), AS_OF)


_FORM = ", ".join(f"""count(*) FILTER (rn <= {n}) AS matches_{n}, coalesce(sum(won) FILTER (rn <= {n}), 0)::BIGINT AS wins_{n},
  floor(sum(won) FILTER (rn <= {n}) * 1e4 / count(*) FILTER (rn <= {n}) + 0.5) / 1e4 AS win_rate_{n},
  floor(sum(set_diff) FILTER (rn <= {n}) * 1e4 / count(*) FILTER (rn <= {n}) + 0.5) / 1e4 AS set_diff_avg_{n},
  floor(sum(game_diff) FILTER (rn <= {n}) * 1e4 / count(*) FILTER (rn <= {n}) + 0.5) / 1e4 AS game_diff_avg_{n},
  count(*) FILTER (rn <= {n} AND DATE '{AS_OF}' - match_date BETWEEN 0 AND 7) AS fatigue_7d_{n},
  count(*) FILTER (rn <= {n} AND DATE '{AS_OF}' - match_date BETWEEN 0 AND 3) AS fatigue_3d_{n}""" for n in (10, 5))
FORM_SQL = f"""SELECT player_key, {_FORM} FROM (SELECT *, row_number() OVER (PARTITION BY player_key ORDER BY match_date DESC, seq DESC) AS rn
  FROM played_v WHERE match_date < DATE '{AS_OF}') WHERE rn <= 10 GROUP BY player_key"""


@query("w1_form_last_n", FORM_SQL)
def w1(spark, sf):
    return form(spark, sf)


H2H_SQL = """SELECT least(winner_key, loser_key) AS first_key, greatest(winner_key, loser_key) AS second_key, count(*) AS meetings,
  count(*) FILTER (winner_key < loser_key) AS first_wins, count(*) FILTER (winner_key > loser_key) AS second_wins FROM valid_v GROUP BY 1, 2"""


@query("w2_h2h", H2H_SQL)
def w2(spark, sf):
    return W.head_to_head(views.matches(spark, sf))


@query("p9_support_labels", f"""
WITH f AS ({FORM_SQL}), h AS ({H2H_SQL}),
s AS (SELECT seq, winner_key AS own_key, loser_key AS other_key FROM valid_v UNION ALL SELECT seq, loser_key, winner_key FROM valid_v),
j AS (SELECT s.*, floor((coalesce(a.win_rate_10, 0) - coalesce(b.win_rate_10, 0)) * 1e6 + 0.5) / 1e6 AS win_rate_diff, h.meetings AS h2h_meetings,
  CASE WHEN own_key < other_key THEN first_wins ELSE second_wins END AS h2h_own_wins, CASE WHEN own_key < other_key THEN second_wins ELSE first_wins END AS h2h_other_wins,
  coalesce(a.fatigue_3d_10, 0) - coalesce(b.fatigue_3d_10, 0) AS gap
  FROM s LEFT JOIN f a ON a.player_key = own_key LEFT JOIN f b ON b.player_key = other_key
  JOIN h ON h.first_key = least(own_key, other_key) AND h.second_key = greatest(own_key, other_key))
SELECT seq, own_key, other_key, win_rate_diff, h2h_meetings, h2h_own_wins, h2h_other_wins,
  CASE WHEN win_rate_diff >= 0.15 THEN 'FORM_SUPPORTS_PICK' WHEN win_rate_diff <= -0.15 THEN 'FORM_AGAINST_PICK' ELSE 'FORM_NEUTRAL' END AS form_support,
  CASE WHEN h2h_meetings < 3 THEN 'H2H_TOO_SMALL' WHEN h2h_own_wins > h2h_other_wins THEN 'H2H_SUPPORTS_PICK' WHEN h2h_own_wins < h2h_other_wins
    THEN 'H2H_AGAINST_PICK' ELSE 'H2H_NEUTRAL' END AS h2h_support,
  CASE WHEN gap >= 2 THEN 'FATIGUE_RISK_PICK' WHEN gap <= -2 THEN 'FATIGUE_EDGE_PICK' ELSE 'FATIGUE_NEUTRAL' END AS fatigue_flag FROM j""")
def p9(spark, sf):
    m = views.valid_matches(spark, sf)
    side = lambda a, b: F.struct(F.col(a).alias("own_key"), F.col(b).alias("other_key"))
    sides = m.select("seq", F.explode(F.array(side("winner_key", "loser_key"), side("loser_key", "winner_key"))).alias("s")).select("seq", "s.*")
    return W.label_sides(sides, form(spark, sf), W.head_to_head(m))


def ledger(spark, sf):
    p = views.picks(spark, sf)
    return p.withColumn("profit", L.profit(F.col("status"), F.col("stake"), F.col("odds")))


ORDER = ("pick_date", "pick_time", "tournament", "match_name", "pick_id")
RUNNING = """SELECT pick_id, status, {0} AS running_wins, {1} AS running_losses, {0} || '-' || {1} AS running_w_l, {2}::DOUBLE AS running_total_stake,
  {3}::DOUBLE AS running_total_profit, floor({3}::DOUBLE * 1e6 / nullif({2}::DOUBLE, 0) + 0.5) / 1e6 AS running_roi
FROM (SELECT *, sum(CASE WHEN status = 'win' THEN 1 ELSE 0 END) OVER w AS a, sum(CASE WHEN status = 'loss' THEN 1 ELSE 0 END) OVER w AS b,
  sum(CASE WHEN status = 'pending' THEN 0 ELSE stake END) OVER w AS c, sum(CASE WHEN status = 'pending' THEN 0 ELSE profit END) OVER w AS d FROM ledger_v
  WINDOW w AS (ORDER BY pick_date, pick_time, tournament, match_name, pick_id ROWS UNBOUNDED PRECEDING))"""
RUN_COLUMNS = ("pick_id", "status", "running_wins", "running_losses", "running_w_l", "running_total_stake", "running_total_profit", "running_roi")


@query("w3_running_ledger", RUNNING.format(*[f"(CASE WHEN status <> 'pending' THEN {c} END)" for c in "abcd"]))
def w3(spark, sf):
    return L.running_ledger(ledger(spark, sf), ORDER).select(*RUN_COLUMNS)


@query("w3_running_ledger_carry", RUNNING.format(*"abcd"))
def w3_carry(spark, sf):
    return L.running_ledger(ledger(spark, sf), ORDER, carry_pending=True).select(*RUN_COLUMNS)


_STATE = SETTLE_STATUS.format("trim(concat_ws(' ', event_status, event_status_info, event_status_type))")
_WINNER = """CASE WHEN event_winner IN ('First Player', '1') OR winner_key = first_player_key OR lower(winner_name) = lower(event_first_player) THEN 'home'
    WHEN event_winner IN ('Second Player', '2') OR winner_key = second_player_key OR lower(winner_name) = lower(event_second_player) THEN 'away' END"""
SETTLE = f"""SELECT p.*, reason, CASE WHEN reason LIKE 'settled_%' THEN substr(reason, 9) ELSE 'pending' END AS result,
  CAST(CASE reason WHEN 'settled_win' THEN coalesce(stake, 1) * (coalesce(odds, avg_odds) - 1) WHEN 'settled_loss' THEN -coalesce(stake, 1) WHEN 'settled_void' THEN 0 END AS DECIMAL(18,6)) AS profit
FROM (SELECT p.*, CASE WHEN r.event_key IS NULL THEN 'fixture_not_found' WHEN state = 'void' THEN 'settled_void' WHEN state <> 'finished' THEN state
    WHEN w IS NULL THEN 'finished_without_winner' WHEN side = 'both' THEN 'unknown_side'
    WHEN w = CASE WHEN lower(side) IN ('home', 'first', 'first player', '1') THEN 'home' ELSE 'away' END THEN 'settled_win' ELSE 'settled_loss' END AS reason
  FROM settle_picks_v p LEFT JOIN (SELECT event_key, event_date, {_STATE} AS state, {_WINNER} AS w
    FROM results_v QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY row_order DESC) = 1) r
    ON r.event_key = p.event_key AND r.event_date <= p.pick_date + {{days}}) p"""
SETTLE_STREAM, SETTLE = SETTLE.format(days=7), SETTLE.format(days=100000)


def settled(spark, sf):
    return L.settle_by_event(views.settle_picks(spark, sf), views.results(spark, sf), ["row_order"])


@query("s1_settle_by_event", f"SELECT pick_id, reason AS settle_reason, result, profit::DOUBLE AS profit FROM ({SETTLE})")
def s1(spark, sf):
    return settled(spark, sf).select("pick_id", "settle_reason", "result", "profit")


@query("s2_settle_by_keys", """
WITH src AS (SELECT 0 AS priority, 'pick_id:' || pick_id AS key, * FROM source_results_v WHERE pick_id IS NOT NULL
  UNION ALL SELECT 1, 'event_key:' || event_key, * FROM source_results_v WHERE event_key IS NOT NULL
  UNION ALL SELECT 2, 'fixture_id:' || fixture_id, * FROM source_results_v WHERE fixture_id IS NOT NULL
  UNION ALL SELECT 3, 'combo:' || date || '|' || player_key || '|' || opponent_key || '|' || side, * FROM source_results_v),
last AS (SELECT key, any_value(priority) AS priority, lower(arg_max(result, row_no)) AS result, arg_max({'p': profit}, row_no).p AS profit FROM src
  WHERE lower(result) IN ('win', 'loss', 'void', 'push') GROUP BY key),
hit AS (SELECT a.pick_id, l.* FROM (SELECT pick_id, unnest(['pick_id:' || pick_id, 'event_key:' || event_key, 'fixture_id:' || fixture_id,
    'combo:' || date || '|' || player_key || '|' || opponent_key || '|' || side]) AS key FROM active_v) a JOIN last l USING (key)
  QUALIFY row_number() OVER (PARTITION BY a.pick_id ORDER BY l.priority) = 1),
s AS (SELECT a.pick_id, a.stake, coalesce(h.result, 'pending') AS result, CASE WHEN h.result IS NOT NULL THEN
  coalesce(h.profit, CASE h.result WHEN 'win' THEN a.stake * (a.odds - 1) WHEN 'loss' THEN -a.stake ELSE 0 END) END AS profit
  FROM active_v a LEFT JOIN hit h USING (pick_id))
SELECT pick_id, result, floor(profit * 1e6 + 0.5) / 1e6 AS profit, floor(profit * 1e6 / stake + 0.5) / 1e6 AS roi FROM s""")
def s2(spark, sf):
    src = views.source_results(spark, sf).withColumn("order_no", F.col("row_no"))
    matched = M.settle_by_key_variants(views.active_picks(spark, sf), src, "order_no", ["result", "profit"])
    return L.settle_by_source(matched).select("pick_id", "result", "profit", "roi")


@query("s3_ledger_upsert", f"""
SELECT pick_id, CASE WHEN reason LIKE 'settled_%' THEN result WHEN pick_id % 3 = 0 THEN 'old' ELSE 'pending' END AS status,
  CASE WHEN reason LIKE 'settled_%' THEN 'settled' WHEN pick_id % 3 = 0 THEN 'ledger' ELSE 'pending' END AS origin FROM ({SETTLE})""")
def s3(spark, sf):
    s = settled(spark, sf)
    # every third pick is already in the ledger with an older state
    row = lambda df, status, origin: df.select("pick_id", "pick_date", status.alias("status"), F.lit(origin).alias("origin"))
    done = F.col("settle_reason").startswith("settled_")
    ledger_rows = row(s.withColumn("pick_id", F.when(F.col("pick_id") % 3 == 0, F.col("pick_id"))), F.lit("old"), "ledger")
    return L.ledger_upsert(ledger_rows, row(s.where(done), F.col("result"), "settled"),
                           row(s.where(~done), F.lit("pending"), "pending")).select("pick_id", "status", "origin")


@query("s4_ledger_summary", """
SELECT count(*) AS total_tracked, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status <> 'pending') AS settled,
  count(*) FILTER (status = 'win') AS wins, count(*) FILTER (status = 'loss') AS losses, sum(stake) FILTER (status <> 'pending')::DOUBLE AS total_stake,
  sum(profit) FILTER (status <> 'pending')::DOUBLE AS total_profit,
  count(*) FILTER (status = 'win') || '-' || count(*) FILTER (status = 'loss') AS w_l,
  floor(count(*) FILTER (status = 'win') * 1e6 / count(*) FILTER (status IN ('win', 'loss')) + 0.5) / 1e6 AS hit_rate,
  floor(sum(profit) FILTER (status <> 'pending')::DOUBLE * 1e6 / sum(stake) FILTER (status <> 'pending')::DOUBLE + 0.5) / 1e6 AS roi FROM ledger_v""")
def s4(spark, sf):
    return L.ledger_summary(ledger(spark, sf))
