"""DuckDB statements equivalent to the registered queries.

They are written independently of the Spark plans: plain windows over whole keys, EXISTS
lookups for novelty and one CASE per rule.
"""

from __future__ import annotations

from vigilcard.catalog import SNAPSHOT_DOUBLES, SNAPSHOT_TEXT, SNAPSHOT_WHOLE
from vigilcard.config import DEFAULT_HIGH_RISK_CATEGORIES, DEFAULT_RULES
from vigilcard.functions.geo import CITIES, EARTH_RADIUS_KM
from vigilcard.plans.fixtures import BINS, CATEGORIES, CITY_NAMES, SPLIT
from vigilcard.plans.reports import SCENARIOS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TX = f"""
packed AS (
  SELECT event_id, user_id, event_type, value,
         make_timestamp(epoch_us(ts) - epoch_us(ts) % 3600000000 + (epoch_us(ts) % 3600000000) // 6) AS ts1,
         CASE WHEN user_id % 5 = 0 THEN event_id % 2 ELSE 0 END AS cardno
  FROM events),
tx AS (
  SELECT event_id,
    'tx_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
    'C' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS customer_id,
    {_list(BINS)}[user_id % 4 + 1] || lpad(CAST(user_id * 2 + cardno AS VARCHAR), 10, '0') AS card_id,
    CASE WHEN ts1 < TIMESTAMP '{SPLIT}'
          AND ((user_id % 10 = 5 AND cardno = 1) OR (user_id % 10 = 7 AND cardno = 0))
         THEN ts1 - INTERVAL 200 DAY ELSE ts1 END AS timestamp,
    round(CASE WHEN event_id % 12 = 5 THEN 1 + floor(value) / 100
               WHEN event_id % 31 = 0 THEN value * 90
               ELSE value * 4 + 20 END, 2) AS amount,
    'BRL' AS currency,
    'M' || lpad(CAST(event_id % 248 AS VARCHAR), 5, '0') AS merchant_id,
    {_list(CATEGORIES)}[event_id % 12 + 1] AS merchant_category,
    CASE WHEN event_id % 9 = 0 THEN {_list(CITY_NAMES)}[event_id % 11 + 1]
         ELSE {_list(CITY_NAMES)}[user_id % 8 + 1] END AS merchant_city,
    'BR' AS merchant_country,
    'T' || lpad(CAST(event_id % 40 AS VARCHAR), 7, '0') AS terminal_id,
    CASE WHEN user_id % 4 = 0 THEN
           CASE WHEN event_id % 97 = 0 THEN 'magnetic' WHEN event_id % 10 < 7 THEN 'chip' ELSE 'contactless' END
         WHEN event_id % 10 < 6 THEN 'chip' WHEN event_id % 10 < 8 THEN 'contactless'
         WHEN event_id % 10 = 8 THEN 'magnetic' ELSE 'ecommerce' END AS entry_mode,
    CASE WHEN event_id % 4 = 0 THEN NULL
         WHEN event_id % 53 = 1 OR (event_id % 31 = 0 AND event_id % 2 = 1) THEN 'DVR-NEW-' || event_id
         ELSE 'DVR-' || user_id || '-' || (event_id % 2) END AS device_id,
    CASE WHEN event_id % 10 = 9 THEN 'online' WHEN event_id % 23 = 0 THEN 'atm' ELSE 'pos' END AS channel,
    CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS auth_result
  FROM packed),
labels_of AS (
  SELECT transaction_id, event_id % 31 = 0 OR event_id % 9 = 0 AS is_fraud,
         CASE WHEN event_id % 31 = 0 THEN 'unusual_amount' WHEN event_id % 9 = 0 THEN 'impossible_travel'
              ELSE 'none' END AS fraud_type
  FROM tx WHERE event_id % 10 <> 3)"""

RAW = (
    "transaction_id, customer_id, card_id, timestamp, amount, currency, merchant_id, merchant_category, "
    "merchant_city, merchant_country, terminal_id, entry_mode, device_id, channel, auth_result"
)

_CITY_VALUES = ", ".join(f"('{city}', {lat}, {lon})" for city, lat, lon in CITIES)
_HIGH_RISK = ", ".join(f"'{code}'" for code in DEFAULT_HIGH_RISK_CATEGORIES)


def _range(column: str, seconds: int) -> str:
    return f"(PARTITION BY {column} ORDER BY ep RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)"


# Windows over all transactions; part 0 is history, higher parts are batches in order.
_CARD = "OVER (PARTITION BY card_id ORDER BY ep, transaction_id)"


def windows(part: str = f"CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END") -> str:
    return f"""
parts AS (SELECT *, CAST(floor(epoch(timestamp)) AS BIGINT) AS ep, substr(card_id, 1, 6) AS bin, {part} AS part FROM tx),
wins AS (
  SELECT *,
    count(*) OVER {_range('card_id', 60)} AS velocity_1min,
    count(*) OVER {_range('card_id', 300)} AS velocity_5min,
    count(*) OVER {_range('card_id', 3600)} AS velocity_1h,
    count(*) OVER {_range('card_id', 86400)} AS velocity_24h,
    count(*) OVER {_range('card_id', 600)} AS count_10min,
    coalesce(sum(amount) OVER {_range('card_id', 600)}, 0) AS sum_10min,
    coalesce(min(amount) OVER {_range('card_id', 600)}, 0) AS min_10min,
    coalesce(avg(amount) OVER {_range('customer_id', 7776000)}, 0) AS mean90,
    coalesce(stddev_samp(amount) OVER {_range('customer_id', 7776000)}, 0) AS std90,
    count(amount) OVER {_range('customer_id', 7776000)} AS count90,
    CAST(coalesce(sum(CASE WHEN auth_result = 'declined' THEN 1 ELSE 0 END) OVER {_range('bin', 900)}, 0) AS BIGINT)
      AS bin_denials_15min,
    lag(timestamp) {_CARD} AS prev_ts,
    lag(merchant_city) {_CARD} AS prev_merchant_city,
    lag(terminal_id) {_CARD} AS prev_terminal_id,
    lag(device_id) {_CARD} AS prev_device_id,
    lag(amount) {_CARD} AS prev_amount,
    lag(entry_mode) {_CARD} AS prev_entry_mode,
    lag(transaction_id) {_CARD} AS previous_transaction_id,
    coalesce(lag(auth_result) OVER (PARTITION BY bin ORDER BY ep, transaction_id) = 'approved', FALSE)
      AS prev_bin_approved
  FROM parts)"""


def _never(column: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM parts h WHERE h.part < w.part AND h.card_id = w.card_id AND h.{column} = w.{column})"


FLAGS = f"""
flags AS (
  SELECT w.*,
    {_never('terminal_id')} AS new_terminal,
    {_never('device_id')} AS new_device,
    {_never('merchant_city')} AS new_city,
    NOT EXISTS (SELECT 1 FROM parts h WHERE h.part < w.part AND h.card_id = w.card_id
                AND h.entry_mode NOT IN ('chip', 'contactless')) AS chip_only
  FROM wins w WHERE w.part > 0)"""

NO_HISTORY_FLAGS = """
flags AS (SELECT w.*, TRUE AS new_terminal, TRUE AS new_device, TRUE AS new_city, FALSE AS chip_only FROM wins w)"""

_USED_BEFORE = "h.transaction_id <> w.transaction_id AND h.timestamp <= w.timestamp AND h.card_id = w.card_id"
REPLAY_FLAGS = f"""
flags AS (
  SELECT w.* EXCLUDE (prev_ts, prev_merchant_city, prev_terminal_id, prev_device_id, prev_amount, prev_entry_mode,
                      previous_transaction_id, prev_bin_approved),
    p.timestamp AS prev_ts, p.merchant_city AS prev_merchant_city, p.device_id AS prev_device_id,
    p.transaction_id AS previous_transaction_id, coalesce(b.auth_result = 'approved', FALSE) AS prev_bin_approved,
    NOT EXISTS (SELECT 1 FROM parts h WHERE {_USED_BEFORE} AND h.terminal_id = w.terminal_id) AS new_terminal,
    NOT EXISTS (SELECT 1 FROM parts h WHERE {_USED_BEFORE} AND h.device_id = w.device_id) AS new_device,
    NOT EXISTS (SELECT 1 FROM parts h WHERE {_USED_BEFORE} AND h.merchant_city = w.merchant_city) AS new_city,
    NOT EXISTS (SELECT 1 FROM parts h WHERE {_USED_BEFORE} AND h.entry_mode NOT IN ('chip', 'contactless')) AS chip_only
  FROM wins w
  LEFT JOIN (
    SELECT w.transaction_id AS id, arg_max(h.transaction_id, (h.ep, h.transaction_id)) AS pid
    FROM parts w JOIN parts h ON h.card_id = w.card_id AND h.timestamp <= w.timestamp
      AND (h.ep < w.ep OR h.transaction_id < w.transaction_id)
    GROUP BY ALL) pc ON pc.id = w.transaction_id
  LEFT JOIN parts p ON p.transaction_id = pc.pid
  LEFT JOIN (
    SELECT id, arg_max(pid, (pe, pid)) AS pid FROM (
      SELECT w.transaction_id AS id, h.transaction_id AS pid, h.ep AS pe
      FROM parts w JOIN parts h ON h.bin = w.bin AND h.ep = w.ep
        AND h.timestamp <= w.timestamp AND h.transaction_id < w.transaction_id
      UNION ALL
      SELECT w.transaction_id, s.last_id, s.ep
      FROM parts w ASOF JOIN (SELECT bin, ep, max(transaction_id) AS last_id FROM parts GROUP BY ALL) s
        ON s.bin = w.bin AND s.ep < w.ep) GROUP BY ALL) pb ON pb.id = w.transaction_id
  LEFT JOIN parts b ON b.transaction_id = pb.pid)"""

FEATURES = f"""
cities(city, lat, lon) AS (VALUES {_CITY_VALUES}),
placed AS (
  SELECT f.*,
    greatest(0, (epoch_us(timestamp) - epoch_us(prev_ts)) / 60000000.0) AS minutes0,
    coalesce((epoch_us(timestamp) - epoch_us(prev_ts)) / 86400000000.0, 0) AS dormant_days,
    coalesce(2 * {EARTH_RADIUS_KM} * asin(sqrt(greatest(0.0, least(1.0,
      pow(sin(radians(c.lat - p.lat) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - p.lon) / 2), 2))))), 0) AS known_distance,
    p.city IS NOT NULL AND c.city IS NOT NULL AS both_known,
    CASE WHEN mean90 > 0 AND std90 > 0 THEN (amount - mean90) / std90 ELSE 0 END AS zscore,
    CASE WHEN mean90 > 0 THEN amount / mean90 ELSE 1 END AS ratio,
    CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
    merchant_category IN ({_HIGH_RISK}) AS high_risk_merchant
  FROM flags f LEFT JOIN cities p ON p.city = f.prev_merchant_city LEFT JOIN cities c ON c.city = f.merchant_city),
moved AS (
  SELECT *, CASE WHEN prev_ts IS NULL THEN NULL ELSE minutes0 END AS minutes,
            CASE WHEN both_known THEN known_distance ELSE 0 END AS distance FROM placed),
feats AS (
  SELECT *, CASE WHEN minutes > 0 THEN distance / (minutes / 60) ELSE 0 END AS speed FROM moved)"""

_PROBE = (
    "count_10min >= 1 AND min_10min > 0 AND min_10min < 10 AND amount >= 5 * min_10min "
    "AND coalesce(minutes, 0) > 0 AND minutes <= 10"
)
_STRIPE = "entry_mode = 'magnetic' AND chip_only AND amount > 0"
_PLACE = (
    "prev_merchant_city IS NOT DISTINCT FROM merchant_city AND amount > 0 "
    "AND (new_terminal OR coalesce(prev_merchant_city, '') <> '')"
)
_FOLLOW = f"(({_PROBE}) AND (({_PLACE}) OR ({_STRIPE})))"
CONDITIONS = {
    "card_cloning": f"{_FOLLOW} OR (({_STRIPE}) AND amount >= 30)",
    "unusual_amount": "count90 >= 5 AND amount >= 800 AND zscore >= 5.5 AND ratio >= 4",
    "impossible_travel": "distance >= 50 AND speed > 900",
    "new_device_high_amount": "new_device AND coalesce(device_id, '') <> '' AND amount > 800 AND mean90 > 0 "
    "AND amount > 4 * mean90",
    "dormant_card_wake": "dormant_days > 180 AND amount > 500 AND ((mean90 > 0 AND amount > 2 * mean90) "
    "OR (mean90 <= 0 AND amount >= 1000))",
    "bin_attack": "bin_denials_15min >= 3 AND NOT prev_bin_approved",
    "unusual_hour_and_place": "amount >= 300 AND hour_of_day BETWEEN 2 AND 4 AND new_city "
    "AND coalesce(prev_merchant_city, '') <> '' AND prev_merchant_city <> merchant_city",
}
REASONS = {
    "card_cloning": f"""CASE WHEN {_FOLLOW}
      THEN printf('teste R$ %.2f seguido de R$ %.2f em %.0fmin (%d tx em 10min)',
                  CAST(min_10min AS DOUBLE), amount, minutes, count_10min)
      ELSE printf('tarja magnética em cartão com histórico 100%% chip (R$ %.2f)', amount) END""",
    "unusual_amount": "printf('valor R$ %.2f fora do padrão histórico (z=%.1f, média R$ %.2f)', amount, zscore, mean90)",
    "impossible_travel": "printf('deslocamento impossível: %s → %s (%.0f km em %.0fmin = %.0f km/h)', "
    "prev_merchant_city, merchant_city, distance, minutes, speed)",
    "new_device_high_amount": "printf('dispositivo nunca visto (%s) com valor R$ %.2f (%.1fx a média R$ %.2f)', "
    "device_id, amount, amount / mean90, mean90)",
    "dormant_card_wake": """CASE WHEN mean90 > 0
      THEN printf('cartão inativo %d dias: transação de R$ %.2f (%.1fx média R$ %.2f)',
                  CAST(floor(dormant_days) AS BIGINT), amount, amount / mean90, CAST(mean90 AS DOUBLE))
      ELSE printf('cartão inativo %d dias: reativação com valor R$ %.2f',
                  CAST(floor(dormant_days) AS BIGINT), amount) END""",
    "bin_attack": "printf('%d negadas em %s nos últimos 15min sem aprovação prévia', bin_denials_15min, bin)",
    "unusual_hour_and_place": "printf('transação na madrugada (%dh) em cidade não habitual (%s)', "
    "hour_of_day, merchant_city)",
}
WEIGHTS = {name: float(rule["weight"]) for name, rule in DEFAULT_RULES.items()}


def scored(rules=tuple(CONDITIONS)) -> str:
    score = " + ".join(f"CASE WHEN {CONDITIONS[r]} THEN {WEIGHTS[r]} ELSE 0 END" for r in rules)
    names = ", ".join(f"CASE WHEN {CONDITIONS[r]} THEN '{r}' END" for r in rules)
    reasons = ", ".join(f"CASE WHEN {CONDITIONS[r]} THEN {REASONS[r]} END" for r in rules)
    return f"""
points AS (
  SELECT *, CAST(least(100, greatest(0, {score})) AS DOUBLE) AS risk_score,
         concat_ws(',', {names}) AS triggered_rules, concat_ws(' | ', {reasons}) AS reasons_text,
         concat_ws(',', {reasons}) AS rule_reasons FROM feats),
scored AS (
  SELECT *, CASE WHEN risk_score < 30 THEN 'approve' WHEN risk_score < 70 THEN 'review' ELSE 'block' END AS risk_level
  FROM points)"""


ENRICHED_COLUMNS = f"""{RAW}, velocity_1min, velocity_5min, velocity_1h, velocity_24h, count_10min,
  round(sum_10min, 2) AS sum_10min, round(min_10min, 2) AS min_10min, round(zscore, 3) AS amount_zscore,
  CASE WHEN ratio = 0 THEN 1.0 ELSE round(ratio, 3) END AS amount_vs_avg_ratio,
  round(distance, 3) AS distance_from_last_km, round(speed, 3) AS travel_speed_kmh,
  round(coalesce(minutes, 0), 3) AS minutes_since_last, round(dormant_days, 3) AS dormant_days,
  new_terminal, new_device, new_city, chip_only AS entry_mode_chip_only_history, high_risk_merchant, hour_of_day,
  bin_denials_15min, previous_transaction_id, risk_score, risk_level, triggered_rules, rule_reasons,
  TIMESTAMP '2024-02-01 00:00:00' AS decision_timestamp, '1.0.0' AS model_version"""

# Names of the snapshot's fields that differ from those of the window columns.
_SNAPSHOT_NAMES = {
    "amount_count_90d": "count90", "amount_mean_90d": "mean90", "entry_mode_chip_only_history": "chip_only",
    "distance_from_last_km": "distance", "travel_speed_kmh": "speed", "minutes_since_last": "minutes",
    "amount_zscore": "zscore", "amount_vs_avg_ratio": "ratio",
}


def _snapshot() -> str:
    """The fields of an alert's snapshot as one text."""
    parts = []
    for name in (*SNAPSHOT_WHOLE, *SNAPSHOT_TEXT):
        column = _SNAPSHOT_NAMES.get(name, name)
        parts.append(_time_text(column, " ") if name == "prev_ts" else f"CAST({column} AS VARCHAR)")
    for name, digits in SNAPSHOT_DOUBLES.items():
        column = _SNAPSHOT_NAMES.get(name, name)
        parts.append(f"CAST(CAST(round(CAST({column} AS DOUBLE), {digits}) AS DECIMAL(30, {digits})) AS VARCHAR)")
    return "concat_ws('|', " + ", ".join(f"coalesce({part}, '-')" for part in parts) + ") AS feature_snapshot"


def _time_text(column: str, separator: str) -> str:
    whole = f"'%Y-%m-%d{separator}%H:%M:%S'"
    fraction = f"'%Y-%m-%d{separator}%H:%M:%S.%f'"
    return f"""CASE WHEN epoch_us({column}) % 1000000 = 0 THEN strftime({column}, {whole})
      ELSE strftime({column}, {fraction}) END"""


ALERT_COLUMNS = f"""transaction_id, customer_id, card_id, bin, timestamp, round(amount, 2) AS amount, currency,
  merchant_id, merchant_category, merchant_city, merchant_country, entry_mode, channel, risk_score, risk_level,
  triggered_rules, rule_reasons, {_snapshot()}, TIMESTAMP '2024-02-01 00:00:00' AS decision_timestamp,
  '1.0.0' AS model_version"""

PROFILE_COLUMNS = ", ".join(
    f"arg_max({column}, (timestamp, transaction_id)) FILTER (WHERE {column} IS NOT NULL) AS {name}"
    for column, name in (
        ("customer_id", "customer_id"),
        ("timestamp", "last_timestamp"),
        ("merchant_city", "last_city"),
        ("terminal_id", "last_terminal"),
        ("device_id", "last_device"),
        ("amount", "last_amount"),
        ("risk_score", "risk_score"),
        ("risk_level", "risk_level"),
    )
)

ALERTED = "risk_level IN ('review', 'block')"
_BIG = "CAST({} AS BIGINT)"


def _count(condition: str) -> str:
    return _BIG.format(f"count(*) FILTER (WHERE {condition})")


def _on_tx(select: str) -> str:
    return f"WITH {TX} {select}"


def _on_windows(select: str) -> str:
    return f"WITH {TX}, {windows()} {select} FROM wins WHERE part = 1"


def _on_features(select: str) -> str:
    return f"WITH {TX}, {windows()}, {FLAGS}, {FEATURES} {select}"


def _on_scores(select: str, rules=tuple(CONDITIONS)) -> str:
    return f"WITH {TX}, {windows()}, {FLAGS}, {FEATURES}, {scored(rules)} {select}"


def _scenarios(scenarios) -> str:
    values = ", ".join(f"('{name}', {low}, {high})" for name, low, high in scenarios)
    return f"""
SELECT s.scenario, {_count('e.risk_score < s.low')} AS approve_count,
  {_count('e.risk_score >= s.low AND e.risk_score < s.high')} AS review_count,
  {_count('e.risk_score >= s.high')} AS block_count,
  round(100.0 * count(*) FILTER (WHERE e.risk_score >= s.high) / CAST(count(*) AS DOUBLE), 2) AS block_pct,
  round(coalesce(sum(e.amount) FILTER (WHERE e.risk_score >= s.high), 0), 2) AS blocked_amount_brl
FROM scored e CROSS JOIN (VALUES {values}) s(scenario, low, high) GROUP BY s.scenario"""


_HITS = "SELECT transaction_id, unnest(string_split(triggered_rules, ',')) AS rule_name FROM scored WHERE triggered_rules <> ''"

_REPLAY_SIDES = f"""
WITH {TX}, {windows()}, {FLAGS}, {FEATURES}, {scored()},
stored AS MATERIALIZED (SELECT transaction_id, risk_level, risk_score, triggered_rules FROM scored)"""


def _replayed(raw_filter: str) -> str:
    """Decisions of all raw rows recomputed against their own past."""
    text = f"WITH {TX}, {windows('1')}, {REPLAY_FLAGS}, {FEATURES}, {scored()} SELECT * FROM scored"
    return text.replace("FROM tx)", f"FROM tx WHERE {raw_filter})", 2) if raw_filter else text


def _verdicts(raw_filter: str = "") -> str:
    recomputed = _replayed("").replace("part FROM tx", f"part FROM tx {('WHERE ' + raw_filter) if raw_filter else ''}")
    return f"""{_REPLAY_SIDES},
again AS MATERIALIZED (SELECT * FROM ({recomputed})),
verdicts AS (
  SELECT i.transaction_id, s.risk_level AS stored_level, r.risk_level AS recomputed_level,
    s.risk_score AS stored_score, r.risk_score AS recomputed_score,
    coalesce(s.triggered_rules, '') AS stored_rules, coalesce(r.triggered_rules, '') AS recomputed_rules,
    i.part,
    CASE WHEN s.transaction_id IS NULL THEN 'not_in_enriched' WHEN r.transaction_id IS NULL THEN 'not_in_raw'
         WHEN s.risk_level = r.risk_level AND s.risk_score = r.risk_score THEN 'idempotent'
         ELSE 'changed' END AS status
  FROM parts i LEFT JOIN stored s ON s.transaction_id = i.transaction_id
  LEFT JOIN again r ON r.transaction_id = i.transaction_id)"""


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    out["align_transactions"] = _on_tx(f"""
SELECT {RAW.replace('timestamp', 'timestamp AS ts')}, CAST(floor(epoch(timestamp)) AS BIGINT) AS ts_epoch,
  substr(card_id, 1, 6) AS bin FROM tx""")
    out["bin_from_card"] = _on_tx("""
SELECT transaction_id, substr(card_id, 1, 6) AS bin_plain, substr(card_id, 1, 6) AS bin_dashed,
  substr(merchant_city, 1, 6) AS bin_without_digits FROM tx""")
    out["history_excluding_batch"] = _on_tx(f"""
SELECT transaction_id, card_id FROM tx WHERE timestamp < TIMESTAMP '{SPLIT}' AND auth_result <> 'approved'""")
    out["velocity_features"] = _on_windows("""
SELECT transaction_id, velocity_1min, velocity_5min, velocity_1h, velocity_24h, count_10min,
  round(sum_10min, 2) AS sum_10min, round(min_10min, 2) AS min_10min""")
    out["previous_transaction"] = _on_windows("""
SELECT transaction_id, prev_ts, prev_merchant_city, prev_terminal_id, prev_device_id, prev_amount, prev_entry_mode,
  previous_transaction_id""")
    crowded = windows().replace("AS part FROM tx)", f"""AS part FROM (SELECT * REPLACE (
  CASE WHEN event_id % 2 = 0 THEN '4532010000000001' ELSE card_id END AS card_id,
  CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '{SPLIT}' + INTERVAL 60 SECOND ELSE timestamp END AS timestamp) FROM tx))""")
    out["previous_in_hot_second"] = f"""WITH {TX}, {crowded}
SELECT transaction_id, prev_ts, prev_amount, previous_transaction_id, prev_bin_approved FROM wins WHERE part = 1"""
    out["amount_profile"] = _on_features("""
SELECT transaction_id, round(mean90, 8) AS amount_mean_90d, round(std90, 6) AS amount_std_90d,
  count90 AS amount_count_90d, round(zscore, 4) AS amount_zscore, round(ratio, 4) AS amount_vs_avg_ratio FROM feats""")
    larger = windows().replace("AS part FROM tx)", "AS part FROM (SELECT * REPLACE (amount + 1e7 AS amount) FROM tx))")
    out["amount_profile_partials"] = out["amount_profile"]
    out["amount_profile_large"] = f"""WITH {TX}, {larger}
SELECT transaction_id, round(std90, 5) AS amount_std_90d, count90 AS amount_count_90d FROM wins WHERE part = 1"""
    guarded = "CASE WHEN mean90 > 0 AND std90 >= 0.001 THEN (amount - mean90) / std90 ELSE 0 END"
    out["amount_zscore_guarded"] = _on_windows(f"SELECT transaction_id, round({guarded}, 4) AS amount_zscore")
    out["unusual_amount_flag"] = _on_windows(f"""
SELECT transaction_id, {guarded} >= 3 OR CASE WHEN mean90 > 0 THEN amount / mean90 ELSE 1 END >= 1.5 AS unusual_amount""")
    out["customer_mean_std"] = _on_tx("""
SELECT customer_id, round(avg(amount), 4) AS amount_mean, round(coalesce(stddev_samp(amount), 0), 4) AS amount_std
FROM tx GROUP BY customer_id""")
    out["bin_denials"] = _on_windows("SELECT transaction_id, bin, bin_denials_15min, prev_bin_approved")
    out["geo_distance_speed"] = _on_features("""
SELECT transaction_id, round(minutes, 4) AS minutes_since_last, round(distance, 4) AS distance_from_last_km,
  round(speed, 4) AS travel_speed_kmh FROM feats""")
    out["impossible_travel_flag"] = _on_features("""
SELECT transaction_id, distance >= 50 AND speed > 900 AS impossible_travel FROM feats""")
    out["dormancy"] = _on_features("""
SELECT transaction_id, round(dormant_days, 6) AS dormant_days, dormant_days > 180 AS is_dormant FROM feats""")
    out["hour_of_day"] = _on_tx("""
SELECT transaction_id, CAST(hour(timestamp) AS BIGINT) AS hour_of_day, hour(timestamp) BETWEEN 2 AND 5 AS untrusted_hour
FROM tx""")
    out["high_velocity_flag"] = _on_windows("""
SELECT transaction_id, velocity_1min >= 5 AS high_1min, velocity_24h >= 5 AS high_24h, count_10min >= 1 AS any_10min""")
    out["velocity_monotonic_check"] = _on_windows(f"""
SELECT count(*) AS rows_checked, {_count('NOT (velocity_1min <= velocity_5min AND velocity_5min <= velocity_1h AND velocity_1h <= velocity_24h)')}
  AS violations""")
    out["novelty_flags"] = _on_features("SELECT transaction_id, new_terminal, new_device, new_city FROM flags")
    out["chip_only_history"] = _on_features(
        "SELECT transaction_id, chip_only AS entry_mode_chip_only_history FROM flags"
    )
    out["new_device_strict"] = _on_features(
        "SELECT transaction_id, new_device AND coalesce(device_id, '') <> '' AS new_device FROM flags"
    )
    out["two_devices_flag"] = _on_windows("""
SELECT transaction_id, coalesce(device_id <> prev_device_id, FALSE) AS two_devices""")
    out["seen_sets"] = _on_tx(f"""
SELECT DISTINCT card_id, kind, value FROM (
  SELECT card_id, unnest([1, 2, 3, 4])::BIGINT AS kind,
    unnest([terminal_id, device_id, merchant_city,
            CASE WHEN entry_mode NOT IN ('chip', 'contactless') THEN '' END]) AS value
  FROM tx WHERE timestamp < TIMESTAMP '{SPLIT}') WHERE value IS NOT NULL""")
    out["high_risk_merchant"] = _on_tx(
        f"SELECT transaction_id, merchant_category IN ({_HIGH_RISK}) AS high_risk_merchant FROM tx"
    )
    out["merchant_labels"] = _on_tx("""
SELECT transaction_id, merchant_id,
  CASE WHEN CAST(substr(merchant_id, 2) AS INTEGER) % 5 = 0 THEN 'Loja ' || CAST(substr(merchant_id, 2) AS INTEGER)
       WHEN merchant_category = '5411' THEN 'Supermarket' WHEN merchant_category = '5812' THEN 'Restaurant'
       WHEN merchant_category = '5814' THEN 'Fast Food' ELSE merchant_id END AS merchant_label FROM tx""")

    for rule in CONDITIONS:
        out[f"rule_{rule}"] = _on_features(f"""
SELECT transaction_id, '{rule}' AS rule_name, CAST({WEIGHTS[rule]} AS DOUBLE) AS weight, {REASONS[rule]} AS reason
FROM feats WHERE {CONDITIONS[rule]}""")
    out["rules_disabled_subset"] = _on_scores(
        "SELECT transaction_id, risk_score, risk_level, triggered_rules FROM scored",
        ("unusual_amount", "new_device_high_amount", "bin_attack"),
    )
    out["rule_reasons"] = _on_scores(
        "SELECT transaction_id, reasons_text AS rule_reasons FROM scored WHERE reasons_text <> ''"
    )
    out["risk_scores"] = _on_scores(
        "SELECT transaction_id, risk_score, risk_level, triggered_rules, '1.0.0' AS model_version FROM scored"
    )
    enriched = _on_scores(f"SELECT {ENRICHED_COLUMNS} FROM scored")
    alerts = _on_scores(f"SELECT {ALERT_COLUMNS} FROM scored WHERE {ALERTED}")
    dated = "strftime(timestamp, '%Y-%m-%d') AS dt"
    out["enriched_transactions"] = enriched
    out["stream_decisions"] = out["layer_roundtrip_enriched"] = out["snapshot_scoring"] = _on_scores(
        f"SELECT {ENRICHED_COLUMNS}, {dated} FROM scored"
    )
    out["export_enriched_json"] = enriched
    out["alerts"] = alerts
    out["layer_roundtrip_alerts"] = out["export_alerts_csv"] = _on_scores(
        f"SELECT {ALERT_COLUMNS}, {dated} FROM scored WHERE {ALERTED}"
    )
    reasons = " + ".join(f"CAST({CONDITIONS[r].join('()')} AS BIGINT)" for r in CONDITIONS)
    out["alert_feature_snapshot"] = _on_scores(f"""
SELECT transaction_id, velocity_24h, count90 AS amount_count_90d, hour_of_day, bin_denials_15min,
  {_time_text('prev_ts', ' ')} AS prev_ts,
  prev_merchant_city, prev_device_id, previous_transaction_id, CAST(new_city AS VARCHAR) AS new_city,
  round(mean90, 8) AS amount_mean_90d, round(distance, 4) AS distance_from_last_km, risk_score,
  CAST({reasons} AS BIGINT) AS reasons, CAST(32 AS BIGINT) AS fields
FROM scored WHERE {ALERTED}""")
    stats = f"""
SELECT count(*) AS processed, {_count(ALERTED)} AS alerts, {_count("risk_level = 'approve'")} AS approve,
  {_count("risk_level = 'review'")} AS review, {_count("risk_level = 'block'")} AS block,
  round(avg(risk_score), 2) AS avg_score"""
    out["batch_stats"] = _on_scores(f"{stats} FROM scored")
    out["rule_trigger_counts"] = _on_scores(
        f"SELECT rule_name, count(*) AS times_triggered FROM ({_HITS}) GROUP BY rule_name"
    )

    out["ranking_clients_by_alerts"] = _on_scores(f"""
SELECT customer_id, count(*) AS total_alerts, {_count("risk_level = 'block'")} AS block_count,
  {_count("risk_level = 'review'")} AS review_count, round(sum(amount), 2) AS total_suspicious_amount,
  round(avg(risk_score), 1) AS avg_risk_score, max(risk_score) AS max_risk_score
FROM scored WHERE {ALERTED} GROUP BY customer_id
ORDER BY total_alerts DESC, total_suspicious_amount DESC, customer_id LIMIT 20""")
    out["fraud_rate_by_category"] = _on_scores(f"""
SELECT merchant_category, count(*) AS total_transactions, {_count("risk_level = 'block'")} AS block_count,
  {_count("risk_level = 'review'")} AS review_count, {_count(ALERTED)} AS alert_count,
  round(100.0 * count(*) FILTER (WHERE {ALERTED}) / CAST(count(*) AS DOUBLE), 2) AS alert_rate_pct,
  round(sum(amount), 2) AS total_volume_brl,
  round(coalesce(sum(amount) FILTER (WHERE risk_level = 'block'), 0), 2) AS blocked_volume_brl
FROM scored GROUP BY merchant_category""")
    out["rule_effectiveness"] = _on_scores(f"""
SELECT h.rule_name, count(*) AS times_triggered, {_count('l.is_fraud')} AS true_positives,
  {_count('NOT coalesce(l.is_fraud, FALSE)')} AS false_positives,
  round(100.0 * count(*) FILTER (WHERE l.is_fraud) / CAST(count(*) AS DOUBLE), 2) AS precision_pct
FROM ({_HITS}) h LEFT JOIN labels_of l ON l.transaction_id = h.transaction_id GROUP BY h.rule_name""")
    out["false_positives_by_rule"] = _on_scores(f"""
SELECT h.rule_name, {_count('NOT coalesce(l.is_fraud, FALSE)')} AS false_positive_count, count(*) AS total_rule_triggers,
  round(100.0 * count(*) FILTER (WHERE NOT coalesce(l.is_fraud, FALSE)) / CAST((
    SELECT count(*) FROM scored s LEFT JOIN labels_of n ON n.transaction_id = s.transaction_id
    WHERE NOT coalesce(n.is_fraud, FALSE)) AS DOUBLE), 3)
    AS false_positive_rate_on_normal_pct
FROM ({_HITS}) h LEFT JOIN labels_of l ON l.transaction_id = h.transaction_id GROUP BY h.rule_name""")
    out["volume_by_hour"] = _on_scores(f"""
SELECT CAST(hour(timestamp) AS BIGINT) AS hour_of_day, count(*) AS total_transactions,
  {_count("risk_level = 'approve'")} AS approve_count, {_count("risk_level = 'review'")} AS review_count,
  {_count("risk_level = 'block'")} AS block_count, round(avg(risk_score), 2) AS avg_risk_score,
  round(sum(amount), 2) AS total_volume_brl FROM scored GROUP BY 1""")
    out["threshold_comparison"] = _on_scores(_scenarios(SCENARIOS))
    sweep = [(f"{low}/{high}", float(low), float(high)) for low in (20, 35, 50) for high in (60, 75, 90)]
    out["threshold_sweep"] = _on_scores(_scenarios(sweep))
    out["false_positive_rate"] = _on_scores(f"""
SELECT count(*) AS normal_transactions, {_count(ALERTED)} AS false_alerts,
  round(100.0 * count(*) FILTER (WHERE {ALERTED}) / CAST(count(*) AS DOUBLE), 3) AS false_positive_rate_pct
FROM scored s LEFT JOIN labels_of l ON l.transaction_id = s.transaction_id WHERE NOT coalesce(l.is_fraud, FALSE)""")

    out["report_partials"] = out["fraud_rate_by_category"]
    out["report_partials_by_hour"] = out["volume_by_hour"]
    out["report_partials_thresholds"] = out["threshold_sweep"]
    out["layer_roundtrip_raw"] = _on_tx(f"SELECT {RAW}, {dated} FROM tx")
    out["layer_compaction"] = out["layer_roundtrip_raw"]
    out["export_raw_parquet"] = _on_tx(f"SELECT {RAW} FROM tx")
    out["upsert_idempotent"] = _on_tx(f"""
SELECT transaction_id, round(CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN amount ELSE amount + 1000 END, 2) AS amount
FROM tx""")
    out["upsert_id_index"] = _on_tx(f"""
SELECT transaction_id, round(CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN amount ELSE amount + 1000 END, 2) AS amount,
  true AS indexed FROM tx""")
    out["layer_commit_recovery"] = _on_scores(f"""
SELECT 'raw before' AS layer, count(*) AS n FROM tx WHERE timestamp < TIMESTAMP '{SPLIT}'
UNION ALL SELECT 'raw', count(*) FROM tx
UNION ALL SELECT 'ids', count(*) FROM tx
UNION ALL SELECT 'enriched', count(*) FROM scored
UNION ALL SELECT 'audit', count(*) FROM scored
UNION ALL SELECT 'profiles', count(DISTINCT card_id) FROM scored
UNION ALL SELECT 'alerts', count(*) FROM scored WHERE {ALERTED}""")
    out["audit_log"] = _on_scores(f"""
SELECT 'decision' AS event, transaction_id, customer_id, card_id, {_time_text('timestamp', ' ')} AS timestamp,
  amount, risk_score, risk_level, triggered_rules, rule_reasons, '1.0.0' AS model_version,
  '2024-02-01T00:00:00+00:00' AS audit_ts FROM scored""")
    texts = f"{_time_text('timestamp', ' ')} AS timestamp, '2024-02-01 00:00:00' AS decision_timestamp"
    out["audit_alert_events"] = _on_scores(f"""
SELECT 'alert' AS event, * REPLACE ({texts}), '2024-02-01T00:00:00+00:00' AS audit_ts
FROM (SELECT {ALERT_COLUMNS} FROM scored WHERE {ALERTED})""")
    out["upsert_null_and_repeated_ids"] = _on_tx("""
SELECT 'raw' AS layer, transaction_id, round(CASE WHEN entry_mode = 'magnetic' THEN amount + 1000 ELSE amount END, 2) AS amount
FROM tx WHERE channel <> 'atm'
UNION ALL SELECT 'rejected', NULL, round(amount, 2) FROM tx, range(2) WHERE channel = 'atm'""")
    out["views_empty_layers"] = _on_tx("""
SELECT 'raw' AS view, count(*) AS n FROM tx
UNION ALL SELECT * FROM (VALUES ('enriched', 0), ('alerts', 0), ('fraud_labels', 0))""")
    out["adhoc_sql"] = _on_tx("""
SELECT r.merchant_city, r.entry_mode, l.fraud_type, COUNT(*) AS n, ROUND(SUM(r.amount), 2) AS volume
FROM tx r JOIN labels_of l ON r.transaction_id = l.transaction_id
GROUP BY r.merchant_city, r.entry_mode, l.fraud_type""")
    decided = "SELECT transaction_id, risk_score, risk_level, triggered_rules FROM scored"
    first = f"WITH {TX}, {windows('1')}, {NO_HISTORY_FLAGS}, {FEATURES}, {scored()} {decided}"
    out["backfill_decisions"] = first
    out["backfill_limit"] = first.replace(
        "part FROM tx)", "part FROM (SELECT * FROM tx ORDER BY timestamp, transaction_id LIMIT 1000))"
    )
    updated = "TIMESTAMP '2024-02-01 00:00:00' AS updated_at"
    out["card_profiles"] = _on_scores(f"SELECT card_id, {PROFILE_COLUMNS}, {updated} FROM scored GROUP BY card_id")
    out["card_profiles_merge"] = out["card_profiles"]
    out["replay_verify"] = f"""{_verdicts()}
SELECT * EXCLUDE (part), status = 'idempotent' AS idempotent FROM verdicts WHERE part = 1"""
    out["replay_one_id"] = f"""{_verdicts()}
SELECT * EXCLUDE (part), status = 'idempotent' AS idempotent FROM verdicts
WHERE transaction_id = (SELECT min(transaction_id) FROM verdicts WHERE part = 1)"""
    out["replay_missing"] = f"""{_verdicts("auth_result = 'approved'")}
SELECT transaction_id, status, FALSE AS idempotent FROM verdicts WHERE status LIKE 'not_in%'"""

    iso = _time_text("timestamp", "T")
    fields = RAW.replace("timestamp", f"timestamp := {iso}")
    packed = ", ".join(f if ":=" in f else f"{f} := {f}" for f in _split_fields(fields))
    line = f"CAST(to_json(struct_pack({packed})) AS VARCHAR)"
    out["transactions_as_json"] = _on_tx(f"SELECT transaction_id, {line} AS value FROM tx")
    nulls = ", ".join(f"NULL AS {c.strip()}" for c in RAW.split(",")[1:])
    out["stream_parse_json"] = _on_tx(f"""
SELECT {RAW}, 'parsed' AS outcome FROM tx WHERE channel <> 'atm'
UNION ALL BY NAME
SELECT substr({line}, 1, 60) AS transaction_id, {nulls}, 'rejected' AS outcome FROM tx WHERE channel = 'atm'""")
    nameless = line.replace("transaction_id := transaction_id", "transaction_id := CASE WHEN entry_mode <> 'contactless' THEN transaction_id END")
    out["stream_rejected_records"] = _on_tx(f"""
SELECT CASE WHEN channel = 'atm' OR entry_mode = 'contactless' THEN 'rejected' ELSE 'raw' END AS layer,
  CASE WHEN channel = 'atm' THEN substr({nameless}, 1, 60) WHEN entry_mode = 'contactless' THEN {nameless}
       ELSE transaction_id END AS content FROM tx""")
    out["stream_watermark"] = _on_tx("SELECT transaction_id, timestamp FROM tx")
    parted = windows(
        f"CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 0 "
        "WHEN timestamp < TIMESTAMP '2024-01-25 00:00:00' THEN 1 ELSE 2 END"
    )
    out["stream_session_stats"] = f"""WITH {TX}, {parted}, {FLAGS}, {FEATURES}, {scored()}
{stats}, (SELECT count(*) FROM ({_HITS})) AS rules_fired FROM scored"""
    out["stream_reprocess_idempotent"] = _on_scores(f"""
SELECT 'raw' AS layer, count(*) AS n, count(*) AS ids FROM tx
UNION ALL SELECT 'enriched', count(*), count(*) FROM scored
UNION ALL SELECT 'alerts', count(*), count(*) FROM scored WHERE {ALERTED}
UNION ALL SELECT 'audit', 3 * count(*), count(*) FROM scored
UNION ALL SELECT 'audit_distinct', 2 * count(*), count(*) FROM scored""")
    return out


def _split_fields(text: str) -> list[str]:
    """Splits a column list at its top-level commas."""
    fields, depth, current = [], 0, ""
    for char in text:
        depth += {"(": 1, ")": -1}.get(char, 0)
        if char == "," and depth == 0:
            fields.append(current.strip())
            current = ""
        else:
            current += char
    return [*fields, current.strip()]
