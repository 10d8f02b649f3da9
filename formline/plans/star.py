"""The star-schema tables read as a league, so that every operator runs on whole tables.

An order is a game: its customer's nation plays at home, the nation of its first supplier is
away, its lines are the plays. A line is also a pitcher's appearance (the supplier's). The
same definitions stand below as SQL for the comparison engine, in ``CTES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.operators.odds import BOOKMAKERS
from formline.schemas import ODDS_EVENT
from formline.scratch import new_folder
from formline.sources.tables import scan_parquet, sink_warehouse_table

ZONES = ["America/New_York", "America/Chicago", "America/Phoenix", "America/Denver", "America/Los_Angeles"]
VALIDATION_SEASON, TEST_SEASON = 1999, 2000
#: Orders that one task makes nested documents of, some 3 KB each.
DOCUMENTS_PER_TASK = 50_000


_SCANS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCANS:
        _SCANS[key] = scan_parquet(spark, path)
    return _SCANS[key]


def state(status: str, final: str = "F") -> Column:
    return F.when(F.col(status) == final, "Final").when(F.col(status) == "O", "Scheduled").otherwise("In Progress")


def league_size(spark: SparkSession, sf_dir: str) -> int:
    """Teams there are: one per nation."""
    return table(spark, sf_dir, "nation").count()


def game_days(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound of game dates, from one column of the orders."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate")).distinct().count()


def game_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season and date of all orders, among them those of all games."""
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("Season"), F.to_date("o_orderdate").alias("OfficialDate")
    )


def spread(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows of orders dealt by their key to tasks of bounded size, while they are narrow.

    A document is some fifty times its order, so tasks cut by the size of the tables would each build gigabytes.
    """
    tasks = -(-table(spark, sf_dir, "orders").count() // DOCUMENTS_PER_TASK)
    return rows.repartition(tasks, "o_orderkey") if tasks > 1 else rows


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its lines counted.

    Games and batting both need it, so it is computed once per application and stored in buckets of the
    order's key: what joins it reads it without a scan of all lines, a grouping or an exchange.
    """
    key = (spark.sparkContext.applicationId, f"{sf_dir}/order_lines")
    if key not in _SCANS:
        folder = new_folder(spark, "order_lines")
        name = folder.rsplit("/", 1)[1].replace("-", "_")
        sink_warehouse_table(_counted_lines(spark, sf_dir), "default", name, bucket_by=["l_orderkey"], path=folder)
        _SCANS[key] = spark.table(f"default.{name}")
    return _SCANS[key]


def _counted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("n_lines"),
        F.count_if(flag == "R").cast("int").alias("runs"),
        F.count_if((flag == "R") & (status == "O")).cast("int").alias("hits"),
        F.count_if(status == "O").cast("int").alias("atbats"),
        F.sum("l_quantity").cast("int").alias("strikeouts"),
        F.count_if(flag == "A").cast("int").alias("baseonballs"),
        F.count_if(flag == "N").cast("int").alias("intentionalwalks"),
        F.min("l_suppkey").alias("first_supp"),
        F.max("l_suppkey").alias("last_supp"),
    )


def team_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per order and home nation; measures are NULL for orders without lines."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    lines = order_lines(spark, sf_dir).drop("n_lines", "first_supp", "last_supp")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .select(
            F.col("n_name").alias("team_name"),
            F.year("o_orderdate").alias("season"),
            F.to_date("o_orderdate").alias("officialdate"),
            F.col("o_orderkey").alias("id"),
            "runs", "hits", "atbats", "strikeouts", "baseonballs", "intentionalwalks",
            state("o_orderstatus").alias("detailedstate"),
        )
    )


def individual_pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line; a supplier often has several on one date."""
    lines, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    return (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(nation, F.col("s_nationkey") == nation.n_nationkey)
        .select(
            F.col("s_suppkey").alias("player_id"),
            F.col("s_name").alias("player_name"),
            F.col("n_name").alias("team_name"),
            F.year("l_shipdate").alias("season"),
            F.to_date("l_shipdate").alias("officialdate"),
            F.col("l_orderkey").alias("id"),
            F.col("l_quantity").cast("int").alias("strikeouts"),
            F.col("l_linenumber").alias("runs"),
            state("l_linestatus").alias("detailedstate"),
        )
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per order with lines, in the 32 columns of a game."""
    orders, customer, nation, region, supplier = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region", "supplier")
    )
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")

    def side(prefix: str) -> DataFrame:
        return places.select(*[F.col(c).alias(prefix + c) for c in places.columns])

    def starter(prefix: str) -> DataFrame:
        return supplier.select(*[F.col(c).alias(prefix + c) for c in ("s_suppkey", "s_name", "s_nationkey")])

    lines = order_lines(spark, sf_dir)
    joined = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(side("h_"), F.col("c_nationkey") == F.col("h_n_nationkey"))
        .join(starter("a_"), F.col("first_supp") == F.col("a_s_suppkey"))
        .join(starter("h_"), F.col("last_supp") == F.col("h_s_suppkey"))
        .join(side("a_"), F.col("a_s_nationkey") == F.col("a_n_nationkey"))
    )
    number = F.substring("o_orderpriority", 1, 1).cast("int")

    def club(name: str, p: str, wins: Column, losses: Column) -> list[Column]:
        return [
            F.col(f"{p}_n_nationkey").cast("bigint").alias(f"{name}TeamID"),
            F.col(f"{p}_n_name").alias(f"{name}TeamName"),
            F.col(f"{p}_r_name").alias(f"{name}LeagueName"),
            F.substring(f"{p}_n_name", 1, 6).alias(f"{name}TeamShortName"),
            F.col(f"{p}_s_suppkey").alias(f"{name}ProbPitcherID"),
            F.col(f"{p}_s_name").alias(f"{name}ProbPitcherFullName"),
            wins.alias(f"{name}Wins"),
            losses.alias(f"{name}Losses"),
            F.try_divide(wins.cast("double"), wins + losses).alias(f"{name}WinningPercentage"),
        ]

    return joined.select(
        F.col("o_orderkey").alias("GamePK"),
        F.col("o_orderkey").cast("string").alias("GameID"),
        number.alias("GameNumber"),
        F.concat(F.lit("Park of "), "h_n_name").alias("VenueName"),
        F.col("h_n_name").alias("VenueCity"),
        F.col("h_r_name").alias("VenueState"),
        F.year("o_orderdate").alias("Season"),
        F.to_date("o_orderdate").alias("OfficialDate"),
        F.when(number <= 2, "day").otherwise("night").alias("DayNight"),
        F.concat(number.cast("string"), F.lit(":05")).alias("Time"),
        F.when(number <= 2, "AM").otherwise("PM").alias("AMPM"),
        *club("Away", "a", F.col("baseonballs"), F.col("intentionalwalks")),
        *club("Home", "h", F.col("atbats"), F.col("n_lines") - F.col("atbats")),
        state("o_orderstatus").alias("DetailedState"),
        F.col("runs").alias("HomeRuns"),
        F.col("baseonballs").alias("AwayRuns"),
    )


def final_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games(spark, sf_dir).where("DetailedState = 'Final'")


def _stats(**values: str) -> str:
    return "map(" + ", ".join(f"'{k}', cast({v} as string)" for k, v in values.items()) + ")"


def game_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a nested game document with three players a side, built row by row.

    Every third customer's game has no announced away pitcher; ``P`` orders have players
    without statistics.
    """
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    ).join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    rows = spread(spark, sf_dir, rows)
    amount = "cast(floor(o_totalprice) as bigint)"
    away = "cast((n_nationkey + 1) % 25 as bigint)"
    stats = _stats(
        hits=f"{amount} % 11", atbats=f"{amount} % 31", runs=f"{amount} % 7", strikeouts=f"{amount} % 13",
        baseonballs=f"{amount} % 5", intentionalwalks=f"{amount} % 2", homeruns=f"{amount} % 3",
    )
    away_stats = _stats(
        hits=f"{amount} % 10", atbats=f"{amount} % 29", runs=f"{amount} % 6", strikeouts=f"{amount} % 12",
        baseonballs=f"{amount} % 4", intentionalwalks=f"{amount} % 3", homeruns=f"{amount} % 4",
    )
    none = "cast(map() as map<string,string>)"

    def player(i: int, team: str, statistics: str) -> str:
        key = f"o_custkey * 10 + {i}"
        held = f"case when o_orderstatus = 'P' and {i} = 2 then {none} else {statistics} end"
        return (
            f"concat('ID', cast({key} as string)), named_struct('person', named_struct('id', {key}, 'fullname', "
            f"concat('Player {team} ', cast({key} as string))), 'position', named_struct('code', '{1 + i % 2}'), "
            f"'stats', named_struct('batting', {held}, 'pitching', {held}))"
        )

    def box(team_id: str, name: str, label: str, statistics: str) -> str:
        players = ", ".join(player(i, label, statistics) for i in range(3))
        return (
            f"named_struct('team', named_struct('id', {team_id}, 'name', {name}), 'teamstats', "
            f"named_struct('batting', {statistics}, 'pitching', {statistics}), 'players', map({players}))"
        )

    def club(team_id: str, name: str) -> str:
        return (
            f"named_struct('id', {team_id}, 'name', {name}, 'shortname', substring({name}, 1, 6), 'league', "
            f"named_struct('name', 'League'), 'record', named_struct('wins', cast({amount} % 80 as int), 'losses', "
            f"cast({amount} % 70 as int), 'winningpercentage', cast({amount} % 100 as double) / 100))"
        )

    home_id, away_name = "cast(n_nationkey as bigint)", f"concat('NATION_', cast({away} as string))"
    pitcher = "named_struct('id', o_custkey * 10, 'fullname', concat('Player home ', cast(o_custkey * 10 as string)))"
    unknown = f"case when o_custkey % 3 = 0 then null else {pitcher} end"
    return rows.selectExpr(
        "o_orderkey as gamepk",
        "named_struct("
        "'game', named_struct('id', cast(o_orderkey as string), 'gamenumber', cast(substring(o_orderpriority, 1, 1) as int), "
        "'season', year(o_orderdate)), "
        "'datetime', named_struct('officialdate', to_date(o_orderdate), 'daynight', 'day', 'time', '1:05', 'ampm', 'PM'), "
        "'status', named_struct('detailedstate', case o_orderstatus when 'F' then 'Final' else 'Scheduled' end), "
        "'venue', named_struct('name', c_mktsegment, 'location', named_struct('city', n_name, 'state', cast(null as string))), "
        f"'probablepitchers', named_struct('away', {unknown}, 'home', {pitcher}), "
        f"'teams', named_struct('away', {club(away, away_name)}, 'home', {club(home_id, 'n_name')})) as gamedata",
        "named_struct('boxscore', named_struct('teams', named_struct("
        f"'home', {box(home_id, 'n_name', 'home', stats)}, "
        f"'away', {box(away, away_name, 'away', away_stats)}))) as livedata",
    )


def odds_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a nested odds event in ``data``: two bookmakers, up to two markets, two outcomes.

    The home team is the customer, so teams grow with the data. ``P`` orders have a market
    without outcomes, ``O`` orders a second market quoted earlier.
    """
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    rows = spread(spark, sf_dir, rows)
    books = ", ".join(f"'{b}'" for b in BOOKMAKERS)
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    price = "cast(floor(o_totalprice / 1000) as double)"

    def market(key: str, minute: str, shift: int) -> str:
        outcomes = (
            f"array(named_struct('name', c_name, 'price', {price} + {shift} + i), "
            f"named_struct('name', c_mktsegment, 'price', -{price} - {shift} - i))"
        )
        return (
            f"named_struct('key', '{key}', 'last_update', concat({day}, 'T09:{minute}:00Z'), 'outcomes', "
            f"case when o_orderstatus = 'P' then filter({outcomes}, x -> false) else {outcomes} end)"
        )

    markets = (
        f"case when o_orderstatus = 'O' then array({market('h2h', '30', 0)}, {market('lay', '10', 5)}) "
        f"else array({market('h2h', '30', 0)}) end"
    )
    bookmakers = (
        f"transform(array(0, 1), i -> named_struct('key', element_at(array({books}), cast((o_custkey + i) % 6 + 1 as int)), "
        f"'title', concat('Book ', cast(i as string)), 'last_update', concat({day}, 'T09:', lpad(cast(i as string), 2, '0'), ':00Z'), "
        f"'markets', {markets}))"
    )
    event = (
        "named_struct('id', cast(o_orderkey as string), 'sport_key', 'game', 'sport_title', 'Game', 'commence_time', "
        f"concat({day}, 'T', lpad(cast(o_orderkey % 24 as string), 2, '0'), ':00:00Z'), "
        f"'home_team', c_name, 'away_team', c_mktsegment, 'bookmakers', {bookmakers})"
    )
    return rows.select(F.expr(event).cast(ODDS_EVENT).alias("data"))


def team_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone per customer by nation; the last five nations have none."""
    zones = F.array(*[F.lit(z) for z in ZONES])
    return table(spark, sf_dir, "customer").where("c_nationkey < 20").select(
        F.col("c_name").alias("team"), F.get(zones, F.col("c_nationkey") % 5).alias("tz")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line with a probability-like prediction and a 0/1 label."""
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"),
        F.month("l_shipdate").alias("game_month"),
        (F.col("l_discount") * 10).alias("model_prediction"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("HomeTeamWin"),
    )


# --- the same definitions for the comparison engine ---------------------------------------

_STATE = "CASE {0} WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Scheduled' ELSE 'In Progress' END"


def _club_sql(name: str, p: str, wins: str, losses: str) -> str:
    return f"""
      CAST({p}n.n_nationkey AS BIGINT) AS {name}TeamID, {p}n.n_name AS {name}TeamName,
      {p}r.r_name AS {name}LeagueName, substr({p}n.n_name, 1, 6) AS {name}TeamShortName,
      {p}sup.s_suppkey AS {name}ProbPitcherID, {p}sup.s_name AS {name}ProbPitcherFullName,
      {wins} AS {name}Wins, {losses} AS {name}Losses,
      CAST({wins} AS DOUBLE) / nullif({wins} + {losses}, 0) AS {name}WinningPercentage"""


CTES = {
    "order_lines": """
      SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_lines,
        CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS runs,
        CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS INTEGER) AS hits,
        CAST(count(*) FILTER (l_linestatus = 'O') AS INTEGER) AS atbats,
        CAST(sum(l_quantity) AS INTEGER) AS strikeouts,
        CAST(count(*) FILTER (l_returnflag = 'A') AS INTEGER) AS baseonballs,
        CAST(count(*) FILTER (l_returnflag = 'N') AS INTEGER) AS intentionalwalks,
        min(l_suppkey) AS first_supp, max(l_suppkey) AS last_supp
      FROM lineitem GROUP BY l_orderkey""",
    "team_batting": f"""
      SELECT n_name AS team_name, CAST(year(o_orderdate) AS INTEGER) AS season,
        CAST(o_orderdate AS DATE) AS officialdate, o_orderkey AS id, runs, hits, atbats, strikeouts,
        baseonballs, intentionalwalks, {_STATE.format('o_orderstatus')} AS detailedstate
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN order_lines ON o_orderkey = l_orderkey""",
    "team_measures": """
      SELECT DISTINCT team_name, season, officialdate, id, runs,
        CAST(hits AS DOUBLE) / nullif(atbats, 0) AS batting_avg, strikeouts,
        baseonballs + intentionalwalks AS walks
      FROM team_batting""",
    "individual_pitching": f"""
      SELECT s_suppkey AS player_id, s_name AS player_name, n_name AS team_name,
        CAST(year(l_shipdate) AS INTEGER) AS season, CAST(l_shipdate AS DATE) AS officialdate,
        l_orderkey AS id, CAST(l_quantity AS INTEGER) AS strikeouts, l_linenumber AS runs,
        {_STATE.format('l_linestatus')} AS detailedstate
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "pitcher_measures": "SELECT * FROM individual_pitching WHERE detailedstate = 'Final'",
    "games": f"""
      SELECT o_orderkey AS GamePK, CAST(o_orderkey AS VARCHAR) AS GameID,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS GameNumber,
        'Park of ' || hn.n_name AS VenueName, hn.n_name AS VenueCity, hr.r_name AS VenueState,
        CAST(year(o_orderdate) AS INTEGER) AS Season, CAST(o_orderdate AS DATE) AS OfficialDate,
        CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'day' ELSE 'night' END AS DayNight,
        substr(o_orderpriority, 1, 1) || ':05' AS Time,
        CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'AM' ELSE 'PM' END AS AMPM,
        {_club_sql('Away', 'a', 'baseonballs', 'intentionalwalks')},
        {_club_sql('Home', 'h', 'atbats', '(n_lines - atbats)')},
        {_STATE.format('o_orderstatus')} AS DetailedState, runs AS HomeRuns, baseonballs AS AwayRuns
      FROM orders JOIN order_lines ON o_orderkey = l_orderkey
      JOIN customer ON o_custkey = c_custkey
      JOIN nation hn ON c_nationkey = hn.n_nationkey JOIN region hr ON hn.n_regionkey = hr.r_regionkey
      JOIN supplier asup ON first_supp = asup.s_suppkey JOIN supplier hsup ON last_supp = hsup.s_suppkey
      JOIN nation an ON asup.s_nationkey = an.n_nationkey JOIN region ar ON an.n_regionkey = ar.r_regionkey""",
    "final_games": "SELECT * FROM games WHERE DetailedState = 'Final'",
    "odds_rows": """
      SELECT 'game' AS sport_key, 'Game' AS sport_title, c_mktsegment AS away_team, c_name AS home_team,
        CAST(o_orderkey AS VARCHAR) AS id,
        strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00Z' AS commence_time,
        'Book ' || i AS bookmaker_title,
        (['{books}'])[CAST((o_custkey + i) % 6 + 1 AS INTEGER)] AS bookmaker_key,
        strftime(o_orderdate, '%Y-%m-%d') || 'T09:0' || i || ':00Z' AS bookmaker_last_update,
        market_key, strftime(o_orderdate, '%Y-%m-%d') || 'T09:' || minute || ':00Z' AS market_last_update,
        CASE WHEN home THEN c_name ELSE c_mktsegment END AS outcome_name,
        CASE WHEN home THEN 1 ELSE -1 END * (floor(o_totalprice / 1000) + shift + i) AS outcome_price
      FROM orders JOIN customer ON o_custkey = c_custkey
      CROSS JOIN (VALUES (0), (1)) b(i)
      CROSS JOIN (VALUES ('h2h', '30', 0, 'x'), ('lay', '10', 5, 'O')) m(market_key, minute, shift, needs)
      CROSS JOIN (VALUES (true), (false)) s(home)
      WHERE o_orderstatus <> 'P' AND (needs = 'x' OR o_orderstatus = needs)""".replace(
        "{books}", "', '".join(BOOKMAKERS)
    ),
    "team_zones": f"""
      SELECT c_name AS team, ({ZONES})[c_nationkey % 5 + 1] AS tz FROM customer WHERE c_nationkey < 20""",
    "predictions": """
      SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS game_month,
        l_discount * 10 AS model_prediction, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS HomeTeamWin
      FROM lineitem""",
}
