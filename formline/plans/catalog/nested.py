"""Game documents and odds: scans of nested JSON, flattening, prices by bookmaker, start times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.operators import flatten, odds
from formline.operators.columns import union_by_name
from formline.operators.odds import BOOKMAKERS, EVENT_KEYS
from formline.plans import jobs, star
from formline.plans.catalog.registry import query
from formline.schemas import BATTING_STATS, GAME_DOCUMENT, TABLES
from formline.scratch import compressed, new_folder, open_writers
from formline.sources import documents, tables
from formline.sources.csv import CATEGORIES, scan_csv_prefix, scan_year_category_tree

_AMOUNT = "CAST(floor(o_totalprice) AS BIGINT)"
_MODULI = {
    "home": {"hits": 11, "atbats": 31, "runs": 7, "strikeouts": 13, "baseonballs": 5, "intentionalwalks": 2, "homeruns": 3},
    "away": {"hits": 10, "atbats": 29, "runs": 6, "strikeouts": 12, "baseonballs": 4, "intentionalwalks": 3, "homeruns": 4},
}
_NAMES = {"home": "n_name", "away": "'NATION_' || ((n_nationkey + 1) % 25)"}
_IDS = {"home": "CAST(n_nationkey AS BIGINT)", "away": "CAST((n_nationkey + 1) % 25 AS BIGINT)"}
_GAME_SQL = (
    "o_orderkey AS gamepk, CAST(o_orderkey AS VARCHAR) AS id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS gamenumber, "
    "CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderdate AS DATE) AS officialdate, 'day' AS daynight, '1:05' AS time, "
    "'PM' AS ampm, CASE o_orderstatus WHEN 'F' THEN 'Final' ELSE 'Scheduled' END AS detailedstate"
)


def _stats_sql(side: str, names) -> str:
    return ", ".join(f"CAST({_AMOUNT} % {_MODULI[side][n]} AS INTEGER) AS {n}" for n in names)


def _team_sql(names) -> str:
    return " UNION ALL ".join(
        f"SELECT {_stats_sql(s, names)}, {_IDS[s]} AS team_id, {_NAMES[s]} AS team_name, {_GAME_SQL} FROM clubs"
        for s in ("home", "away")
    )


def _player_sql(names, pitchers: bool) -> str:
    kept = "NOT (o_orderstatus = 'P' AND i = 2)" + (" AND i IN (0, 2)" if pitchers else "")
    return " UNION ALL ".join(
        f"SELECT {_stats_sql(s, names)}, o_custkey * 10 + i AS player_id, 'Player {s} ' || (o_custkey * 10 + i) AS player_name, "
        f"'{s}' AS team_type, {_NAMES[s]} AS team_name, {_GAME_SQL} FROM clubs CROSS JOIN (VALUES (0), (1), (2)) p(i) WHERE {kept}"
        for s in ("home", "away")
    )


def _side_sql(side: str, pitcher_known: str) -> str:
    name = side.capitalize()
    return (
        f"{_IDS[side]} AS {name}TeamID, {_NAMES[side]} AS {name}TeamName, 'League' AS {name}LeagueName, "
        f"substr({_NAMES[side]}, 1, 6) AS {name}TeamShortName, "
        f"CASE WHEN {pitcher_known} THEN o_custkey * 10 ELSE -999 END AS {name}ProbPitcherID, "
        f"CASE WHEN {pitcher_known} THEN 'Player home ' || (o_custkey * 10) ELSE 'unannounced' END AS {name}ProbPitcherFullName, "
        f"CAST({_AMOUNT} % 80 AS INTEGER) AS {name}Wins, CAST({_AMOUNT} % 70 AS INTEGER) AS {name}Losses, "
        f"CAST({_AMOUNT} % 100 AS DOUBLE) / 100 AS {name}WinningPercentage"
    )


DOCUMENT_CTES = {
    "clubs": "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "document_games": (
        "SELECT o_orderkey AS GamePK, CAST(o_orderkey AS VARCHAR) AS GameID, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "
        "GameNumber, c_mktsegment AS VenueName, n_name AS VenueCity, CAST(NULL AS VARCHAR) AS VenueState, CAST(year(o_orderdate) AS "
        "INTEGER) AS Season, CAST(o_orderdate AS DATE) AS OfficialDate, 'day' AS DayNight, '1:05' AS Time, 'PM' AS AMPM, "
        + _side_sql("away", "o_custkey % 3 <> 0") + ", " + _side_sql("home", "true")
        + ", CASE o_orderstatus WHEN 'F' THEN 'Final' ELSE 'Scheduled' END AS DetailedState, "
        f"CAST({_AMOUNT} % 7 AS INTEGER) AS HomeRuns, CAST({_AMOUNT} % 6 AS INTEGER) AS AwayRuns FROM clubs"
    ),
}


@query("flatten_games", "SELECT * FROM document_games", DOCUMENT_CTES)
def flatten_games(spark, sf):
    return flatten.flatten_games(star.game_documents(spark, sf))


# All statistics of the documents; no table declares ``homeruns``, and the pitching tables declare two.
ALL_STATS = (*BATTING_STATS, "homeruns")


def _every_stat(rows: DataFrame, kind: str) -> DataFrame:
    """The rows of a kind with all statistics typed, the undeclared ones out of ``stats_extra``."""
    held = {n: F.try_variant_get(flatten.EXTRA, F.lit(f"$.{n}"), "int") for n in ALL_STATS if n not in rows.columns}
    return rows.withColumns({"kind": F.lit(kind), **held}).drop(flatten.EXTRA)


def _kinds_sql(batting: str, pitching: str) -> str:
    return f"SELECT 'batting' AS kind, * FROM ({batting}) UNION ALL SELECT 'pitching' AS kind, * FROM ({pitching})"


@query("flatten_team_stats", _kinds_sql(_team_sql(ALL_STATS), _team_sql(ALL_STATS)), DOCUMENT_CTES)
def flatten_team_stats(spark, sf):
    docs = star.game_documents(spark, sf)
    return union_by_name([_every_stat(flatten.flatten_team_stats(docs, k, extra=True), k) for k in flatten.KINDS])


@query("flatten_player_stats", _kinds_sql(_player_sql(ALL_STATS, False), _player_sql(ALL_STATS, True)), DOCUMENT_CTES)
def flatten_player_stats(spark, sf):
    docs = star.game_documents(spark, sf)
    return union_by_name([_every_stat(flatten.flatten_player_stats(docs, k, extra=True), k) for k in flatten.KINDS])


@query("filter_non_empty_stats", _player_sql(BATTING_STATS, False), DOCUMENT_CTES)
def filter_non_empty_stats(spark, sf):
    return flatten.flatten_player_stats(star.game_documents(spark, sf), "batting")


@query(
    "filter_position",
    "SELECT o_orderkey AS gamepk, side, 'ID' || (o_custkey * 10 + i) AS player_key FROM clubs CROSS JOIN (VALUES (0), (2)) p(i) "
    "CROSS JOIN (VALUES ('home'), ('away')) s(side)",
    DOCUMENT_CTES,
)
def filter_position(spark, sf):
    sides = [
        F.struct(F.lit(side).alias("side"), F.col(f"livedata.boxscore.teams.{side}.players").alias("players")) for side in ("home", "away")
    ]
    players = star.game_documents(spark, sf).select("gamepk", F.inline(F.array(*sides)))
    players = players.select("gamepk", "side", F.explode("players").alias("player_key", "player"))
    return flatten.filter_position(players, "player.position.code", "1").select("gamepk", "side", "player_key")


@query("append_game_columns", f"SELECT c_mktsegment AS venue, {_GAME_SQL} FROM clubs", DOCUMENT_CTES)
def append_game_columns(spark, sf):
    docs = star.game_documents(spark, sf)
    return flatten.append_game_columns(docs, F.col("gamedata.venue.name").alias("venue"))


@query("scan_game_json", "SELECT * FROM document_games", DOCUMENT_CTES)
def scan_game_json(spark, sf):
    path = new_folder(spark, "games-json")
    compressed(star.game_documents(spark, sf)).json(path)
    return flatten.flatten_games(documents.scan_game_json(spark, path))


_BROKEN_SQL = "'{\"gamepk\": ' || o_orderkey || ', \"gamedata\": [oops'"


def _with_broken(spark, sf, documents_json: DataFrame, path: str) -> str:
    """Documents as lines, and one that breaks off for each order of a status."""
    broken = F.concat(F.lit('{"gamepk": '), "o_orderkey", F.lit(', "gamedata": [oops'))
    cut = star.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(broken.alias("value"))
    compressed(documents_json.select(F.to_json(F.struct("*")).alias("value")).unionAll(cut)).text(path)
    return path


@query(
    "bad_record_quarantine",
    f"SELECT 'rejected' AS status, CAST(NULL AS BIGINT) AS gamepk, {_BROKEN_SQL} AS record FROM orders WHERE o_orderstatus = 'P' "
    "UNION ALL SELECT 'read', o_orderkey, NULL FROM clubs",
    DOCUMENT_CTES,
)
def bad_record_quarantine(spark, sf):
    """Both sides of one stored parse: documents that could be read and lines that could not."""
    path = _with_broken(spark, sf, star.game_documents(spark, sf), new_folder(spark, "quarantine"))
    parsed = documents.parse_once(spark, path, GAME_DOCUMENT)
    read = parsed.documents.select(F.lit("read").alias("status"), "gamepk", F.lit(None).cast("string").alias("record"))
    return read.unionAll(parsed.rejects.select(F.lit("rejected"), F.lit(None).cast("bigint"), "record"))


def _odds_rows(spark, sf):
    return odds.unpivot_bookmakers(odds.parse_odds_event(star.odds_events(spark, sf)))


@query(
    "parse_odds_event",
    "SELECT sport_key, sport_title, away_team, home_team, id, commence_time, CAST(k AS INTEGER) AS n_bookmakers FROM (SELECT 'game' AS "
    "sport_key, 'Game' AS sport_title, c_mktsegment AS away_team, c_name AS home_team, CAST(o_orderkey AS VARCHAR) AS id, "
    "strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00Z' AS commence_time, 2 AS k "
    "FROM orders JOIN customer ON o_custkey = c_custkey)",
)
def parse_odds_event(spark, sf):
    """From JSON text, as stored events are."""
    text = star.odds_events(spark, sf).select(F.to_json("data").alias("data"))
    return odds.parse_odds_event(text).select(*odds.EVENT_FIELDS, F.size("bookmakers").alias("n_bookmakers"))


@query("unpivot_bookmakers", "SELECT * FROM odds_rows")
def unpivot_bookmakers(spark, sf):
    return _odds_rows(spark, sf)


@query("scan_odds_json", "SELECT * FROM odds_rows")
def scan_odds_json(spark, sf):
    """A snapshot document per order, holding one event."""
    path = new_folder(spark, "odds-json")
    compressed(star.odds_events(spark, sf).select(F.array("data").alias("data"))).json(path)
    return odds.unpivot_bookmakers(odds.parse_odds_event(documents.scan_odds_json(spark, path)))


_LISTED = BOOKMAKERS[1:4]
_IN_LIST = "(" + ", ".join(f"'{b}'" for b in _LISTED) + ")"


@query("filter_in_list", f"SELECT * FROM odds_rows WHERE bookmaker_key IN {_IN_LIST}")
def filter_in_list(spark, sf):
    return odds.filter_in_list(_odds_rows(spark, sf), "bookmaker_key", _LISTED)


@query("side_filter", "SELECT * FROM odds_rows WHERE outcome_name = home_team")
def side_filter(spark, sf):
    return odds.side_filter(_odds_rows(spark, sf), "home")


# A book quotes several markets: the earliest quoted comes first.
ORDER = ("bookmaker_last_update", "market_last_update")


def _first_sql(book: str, where: str = "true") -> str:
    return (
        "first(outcome_price ORDER BY bookmaker_last_update, market_last_update, outcome_price) FILTER (bookmaker_key = "
        f"'{book}' AND {where})"
    )


_KEYS = ", ".join(EVENT_KEYS)
ODDS_CTES = {
    "pivoted": f"SELECT {_KEYS}, outcome_name, " + ", ".join(f"{_first_sql(b)} AS {b}" for b in BOOKMAKERS)
    + f" FROM odds_rows GROUP BY {_KEYS}, outcome_name",
    "merged": f"SELECT {', '.join('a.' + k for k in EVENT_KEYS)}, "
    + ", ".join(f"{s}.{c} AS {c}_{side}" for s, side in (("a", "away"), ("h", "home")) for c in ("outcome_name", *BOOKMAKERS))
    + " FROM pivoted a JOIN pivoted h ON " + " AND ".join(f"a.{k} = h.{k}" for k in EVENT_KEYS)
    + " WHERE a.outcome_name = a.away_team AND h.outcome_name = h.home_team",
    "timed": "SELECT merged.*, (CAST(replace(commence_time, 'Z', '') AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE coalesce(tz, 'UTC') "
    "AS local_commence_time, (CAST(replace(commence_time, 'Z', '') AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS "
    "eastern_commence_time FROM merged LEFT JOIN team_zones ON home_team = team",
    "formatted": "SELECT *, CAST(eastern_commence_time AS DATE) AS officialDate, CAST(rank() OVER (PARTITION BY home_team, "
    "CAST(eastern_commence_time AS DATE) ORDER BY eastern_commence_time) AS INTEGER) AS gameNumber FROM timed",
}


def _naive_times(df):
    """Wall-clock times without a zone, as the comparison engine gives them."""
    return df.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("local_commence_time", "eastern_commence_time") if c in df.columns
    })


@query("pivot_odds_by_book", "SELECT * FROM pivoted", ODDS_CTES)
def pivot_odds_by_book(spark, sf):
    return odds.pivot_odds_by_book(_odds_rows(spark, sf), order=ORDER)


@query("merge_home_away_odds", "SELECT * FROM merged", ODDS_CTES)
def merge_home_away_odds(spark, sf):
    return odds.merge_home_away_odds(_odds_rows(spark, sf), order=ORDER)


@query(
    "join_inner_using",
    "SELECT id, commence_time, home_team, local_commence_time, eastern_commence_time FROM timed",
    ODDS_CTES,
)
def join_inner_using(spark, sf):
    """Start times per event; the columns are added in place of a self join."""
    merged = odds.merge_home_away_odds(_odds_rows(spark, sf), order=ORDER)
    return _naive_times(odds.localize_odds(merged, star.team_zones(spark, sf))).select(
        "id", "commence_time", "home_team", "local_commence_time", "eastern_commence_time"
    )


@query(
    "daily_game_number",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, c_name AS home_team, eastern_commence_time, CAST(eastern_commence_time AS DATE) AS "
    "officialDate, CAST(rank() OVER (PARTITION BY c_name, CAST(eastern_commence_time AS DATE) ORDER BY eastern_commence_time) AS INTEGER) "
    "AS gameNumber FROM (SELECT o_orderkey, c_name, (o_orderdate + to_hours(o_orderkey % 24)) AT TIME ZONE 'UTC' AT TIME ZONE "
    "'America/New_York' AS eastern_commence_time FROM orders JOIN customer ON o_custkey = c_custkey)",
)
def daily_game_number(spark, sf):
    instant = odds.utc_instant("data.commence_time")
    events = star.odds_events(spark, sf).select(
        "data.id", "data.home_team", odds.utc_to_zone(instant, odds.EASTERN).alias("eastern_commence_time")
    )
    return _naive_times(odds.daily_game_number(events))


@query("format_odds", "SELECT * FROM formatted", ODDS_CTES)
def format_odds(spark, sf):
    path = new_folder(spark, "odds-job")
    _with_broken(spark, sf, star.odds_events(spark, sf).select(F.array("data").alias("data")), path)
    return _naive_times(jobs.format_odds(spark, path, zones=star.team_zones(spark, sf), order=ORDER))


# What a row of every category has: its own name of each common column.
_STAT_ROW = {"season": "season", "officialdate": "officialdate", "id": "id", "detailedstate": "detailedstate", "team_name": "team_name", "runs": "runs"}
_GAME_ROW = {
    "season": "Season", "officialdate": "OfficialDate", "id": "GameID", "detailedstate": "DetailedState", "team_name": "HomeTeamName",
    "runs": "HomeRuns", "player_name": "HomeProbPitcherFullName",
}
_TREE_SQL = {
    "team_batting": _team_sql(["runs"]),
    "team_pitching": _team_sql(["runs"]),
    "individual_batting": _player_sql(["runs"], False),
    "individual_pitching": _player_sql(["runs"], True),
    "games_history": "SELECT * FROM document_games",
}


def _tree_row(table: str) -> dict[str, str]:
    named = _STAT_ROW if table != "games_history" else _GAME_ROW
    return {**named, "player_name": "player_name"} if table.startswith("individual") else named


def _tree_sql(category: str, table: str) -> str:
    named = {"player_name": "CAST(NULL AS VARCHAR)", **_tree_row(table)}
    return f"SELECT '{category}' AS category, " + ", ".join(f"{v} AS {k}" for k, v in named.items()) + f" FROM ({_TREE_SQL[table]})"


def _by_season(rows: DataFrame, seasons: int, label: str) -> DataFrame:
    """The rows stored with a folder per season, so that reading a season opens its files alone; no task sorts rows for that."""
    folder = new_folder(rows.sparkSession, label)
    with open_writers(rows.sparkSession, seasons + 1):
        rows.write.partitionBy(tables.season_column(rows)).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@query("scan_year_category_tree", " UNION ALL ".join(_tree_sql(c, t) for c, t in CATEGORIES.items()), DOCUMENT_CTES)
def year_category_tree(spark, sf):
    """All five categories of a tree with a folder per season, written from the flattened documents."""
    path, docs = new_folder(spark, "scan-tree"), star.game_documents(spark, sf)
    seasons = [r.season for r in docs.select(F.col("gamedata.game.season").alias("season")).distinct().collect()]
    for category, table in CATEGORIES.items():
        level, kind = table.split("_")
        if table == "games_history":
            rows = flatten.flatten_games(docs)
        else:
            rows = (flatten.flatten_team_stats if level == "team" else flatten.flatten_player_stats)(docs, kind)
        rows = _by_season(rows, len(seasons), category)
        for season in seasons:
            own = compressed(rows.where(F.col("season") == season), tables.ROWS_PER_FILE)
            own.option("header", True).csv(f"{path}/{season}/{category}")
    found = scan_year_category_tree(spark, path)
    return union_by_name([
        found[c].select(F.lit(c).alias("category"), *[F.col(v).alias(k) for k, v in _tree_row(t).items()]) for c, t in CATEGORIES.items()
    ])


# --- the ingest and snapshot jobs ----------------------------------------------------------

_PERIOD = ("1996-01-01", "1998-12-31")
_IN_PERIOD = f"BETWEEN DATE '{_PERIOD[0]}' AND DATE '{_PERIOD[1]}'"


_EVER = ("0001-01-01", "9999-12-31")


def _flattened(spark, sf, begin: str, end: str) -> str:
    source = _with_broken(spark, sf, star.game_documents(spark, sf), new_folder(spark, "landing"))
    output = new_folder(spark, "flat")
    jobs.flatten(spark, source, output, begin, end, compression="gzip")
    return output


@query("flatten", f"SELECT * FROM document_games WHERE OfficialDate {_IN_PERIOD}", DOCUMENT_CTES)
def flatten_job(spark, sf):
    """Documents to CSV tables of a period, read back through the prefix scan."""
    return scan_csv_prefix(spark, f"{_flattened(spark, sf, *_PERIOD)}/games_history", TABLES["games_history"])


def _snapshot_rows(spark, target: str, names) -> DataFrame:
    """Some snapshot tables below each other, every statistic typed."""
    out = []
    for name in names:
        rows = tables.scan_parquet(spark, f"{target}/{name}")
        if flatten.EXTRA in rows.columns:
            rows = _every_stat(rows, name.split("_")[1])
        out.append(rows.withColumn("table_name", F.lit(name)))
    return union_by_name(out)


_TABLE_SQL = "SELECT '{0}' AS table_name, * FROM ({1})"


_TABLES_SQL = {
    "games_history": "SELECT * FROM document_games",
    **{f"team_{k}": f"SELECT '{k}' AS kind, * FROM ({_team_sql(ALL_STATS)})" for k in flatten.KINDS},
    **{f"individual_{k}": f"SELECT '{k}' AS kind, * FROM ({_player_sql(ALL_STATS, k == 'pitching')})" for k in flatten.KINDS},
}


@query("snapshot_tables", " UNION ALL BY NAME ".join(_TABLE_SQL.format(t, rows) for t, rows in _TABLES_SQL.items()), DOCUMENT_CTES)
def snapshot_tables(spark, sf):
    """All five tables of all seasons, out of the CSV of the flatten job."""
    target = new_folder(spark, "parquet")
    done = tables.snapshot_tables(spark, _flattened(spark, sf, *_EVER), target)
    return _snapshot_rows(spark, target, [path.rsplit("/", 1)[1] for path in done])


@query(
    "snapshot",
    " UNION ALL ".join(
        _TABLE_SQL.format(f"individual_{k}", f"SELECT '{k}' AS kind, * FROM ({_player_sql(ALL_STATS, k == 'pitching')})") for k in flatten.KINDS
    ),
    DOCUMENT_CTES,
)
def snapshot(spark, sf):
    """All five tables are written; the players' are returned."""
    target = new_folder(spark, "parquet")
    jobs.snapshot(spark, _flattened(spark, sf, *_EVER), target)
    return _snapshot_rows(spark, target, ["individual_batting", "individual_pitching"])
