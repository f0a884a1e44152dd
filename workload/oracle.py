"""The SQL partner of each query, written on its own over the driver's raw tables (DuckDB dialect)."""

from __future__ import annotations


def draw(salt: str, *keys: str, slot: int = 0) -> str:
    """SQL for one 32-bit word of the SHA-256 of ``salt:key:...``, as a fraction of 2^32."""
    parts = ", ".join(f"CAST({key} AS VARCHAR)" for key in keys)
    text = f"sha256(concat_ws(':', '{salt}', {parts}))"
    return f"(CAST(concat('0x', substr({text}, {8 * slot + 1}, 8)) AS UBIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


def whole(value: str) -> str:
    """Truncation towards zero, as an integer."""
    return f"CAST(trunc({value}) AS INTEGER)"


def damaged(salt: str, key: str, slot: int, bad: str, good: str) -> str:
    return f"CASE WHEN {draw(salt, key, slot=slot)} < 0.1 THEN {bad} ELSE {good} END AS {good}"


REALIZED = "payment_status = 'success' AND NOT is_cancelled"

THEATRES = f"""
theatres AS (
  SELECT s_suppkey AS theatre_id, s_name AS name, n_name AS city, r_name AS state,
         CASE WHEN d < 0.55 THEN 'STANDARD' WHEN d < 0.8 THEN 'PREMIUM' WHEN d < 0.9 THEN 'IMAX'
              ELSE 'RECLINER' END AS screen_type,
         60 + CAST(floor(e * 341) AS INTEGER) AS seat_capacity
  FROM (SELECT *, {draw('theatre', 's_suppkey')} AS d, {draw('theatre', 's_suppkey', slot=1)} AS e FROM supplier)
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

MOVIES = f"""
movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, p_type AS genre, 60 + p_size * 2 AS duration_minutes,
         DATE '1998-01-01' + {whole(f"pow({draw('movie', 'p_partkey')}, 2) * -1095")} AS release_date
  FROM part)"""

SHOWS = f"""
shows AS (
  SELECT p_partkey AS show_id, p_partkey // 4 AS movie_id, p_partkey // 20 AS theatre_id,
         CAST(DATE '1998-01-01' + {whole(f"{draw('show', 'p_partkey')} * 730")} AS TIMESTAMP)
           + to_hours(CAST(9 + floor({draw('show', 'p_partkey', slot=1)} * 14) AS INTEGER)) AS showtime,
         p_brand AS screen_type, CAST(round(p_retailprice * 100) AS BIGINT) AS base_price
  FROM part)"""

CUSTOMERS = f"""
customers AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || CASE WHEN c_acctbal < 0 THEN '.at.' ELSE '@' END
           || lower(c_mktsegment) || '.example' AS email,
         lpad(CAST(CAST(floor({draw('customer', 'c_custkey')} * 10000000000) AS BIGINT) AS VARCHAR),
              CASE WHEN c_acctbal < 200 THEN 5 ELSE 10 END, '0') AS phone,
         n_name AS city,
         DATE '1992-01-01' + {whole(f"{draw('customer', 'c_custkey', slot=1)} * 1095")} AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

BOOKING_COLUMNS = """
  l_orderkey || '-' || l_linenumber AS booking_id, l_partkey AS show_id, o_custkey AS customer_id,
  CAST(l_quantity AS INTEGER) AS seats_booked, cents AS ticket_amount,
  cents * CAST(round(l_tax * 100) AS BIGINT) // 100 AS fees,
  cents * CAST(round(l_discount * 100) AS BIGINT) // 100 AS discount,
  o_orderpriority AS payment_gateway,
  CASE l_returnflag WHEN 'N' THEN 'success' WHEN 'R' THEN 'failed' ELSE 'refunded' END AS payment_status,
  CASE o_orderstatus WHEN 'O' THEN 'mobile_app' WHEN 'F' THEN 'web' ELSE 'box_office' END AS booking_channel,
  l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F') AS is_cancelled,
  CAST(o_orderdate AS DATE) AS booking_date, l_shipdate AS _ingested_at"""

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents"

FEED = f"""
feed AS (
  SELECT {BOOKING_COLUMNS}
  FROM (SELECT *, {CENTS} FROM lineitem) JOIN orders ON l_orderkey = o_orderkey)"""

BOOKINGS = f"""
newest AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
    l_returnflag DESC, l_linestatus DESC) AS place
  FROM lineitem),
bookings AS (
  SELECT {BOOKING_COLUMNS}
  FROM (SELECT *, {CENTS} FROM newest WHERE place = 1) JOIN orders ON l_orderkey = o_orderkey)"""

FACT = f"""{BOOKINGS},
fact AS (
  SELECT b.booking_id, b.show_id, p_partkey // 20 AS theatre_id, p_partkey // 4 AS movie_id, b.customer_id,
         CAST(strftime(b.booking_date, '%Y%m%d') AS INTEGER) AS date_key, b.booking_date, b.seats_booked,
         b.ticket_amount, b.fees, b.discount, b.ticket_amount + b.fees - b.discount AS net_revenue,
         b.payment_status, b.payment_gateway, b.booking_channel, b.is_cancelled
  FROM bookings b JOIN part ON b.show_id = p_partkey)"""

OCCUPANCY = f"""{FACT}, {THEATRES}, {SHOWS},
sold AS (SELECT show_id, sum(seats_booked) AS seats FROM fact WHERE {REALIZED} GROUP BY show_id),
occupancy AS (
  SELECT s.show_id, s.theatre_id, s.movie_id, t.city, s.screen_type, CAST(s.showtime AS DATE) AS show_date,
         s.showtime, t.seat_capacity, CAST(coalesce(sold.seats, 0) AS BIGINT) AS seats_sold,
         coalesce(sold.seats, 0)::DOUBLE / t.seat_capacity AS occupancy_rate, t.name AS theatre_name
  FROM shows s JOIN theatres t USING (theatre_id) LEFT JOIN sold USING (show_id))"""

WIDE = f"""{FACT}, {THEATRES}, {MOVIES},
wide AS (
  SELECT f.*, t.city, t.name AS theatre_name, m.title, m.genre
  FROM fact f LEFT JOIN theatres t USING (theatre_id) LEFT JOIN movies m USING (movie_id))"""

FEED_KEYS = ("booking_id", "show_id", "ticket_amount")


def _feed_draw(slot: int) -> str:
    return draw("faults", *FEED_KEYS, slot=slot)


FAULTY_FEED = f"""{FEED},
drawn AS (
  SELECT *, CASE WHEN {_feed_draw(0)} < 0.1 THEN CAST(floor({_feed_draw(1)} * 3) AS INTEGER) ELSE -1 END AS damage,
         CASE WHEN {_feed_draw(2)} < 0.1::DOUBLE / 3 THEN 2 ELSE 1 END AS copies
  FROM feed),
faulty AS (
  SELECT CASE WHEN damage = 2 THEN NULL ELSE booking_id END AS booking_id, show_id,
         CASE WHEN damage = 0 THEN -9999999 ELSE customer_id END AS customer_id, seats_booked,
         CASE WHEN damage = 1 THEN -ticket_amount ELSE ticket_amount END AS ticket_amount,
         fees, discount, payment_gateway, payment_status, booking_channel, is_cancelled, booking_date, _ingested_at
  FROM drawn JOIN (VALUES (1), (2)) AS n(copy) ON copy <= copies)"""

REFERENCED = f"""{FAULTY_FEED},
referenced AS (
  SELECT * FROM faulty WHERE show_id IN (SELECT p_partkey FROM part)
    AND customer_id IN (SELECT c_custkey FROM customer))"""

FAULTY_THEATRES = f"""{THEATRES},
faulty_theatres AS (
  SELECT {damaged('bad theatre', 'k', 0, 'NULL', 'theatre_id')}, name,
         {damaged('bad theatre', 'k', 1, 'NULL', 'city')}, state,
         {damaged('bad theatre', 'k', 2, "'DRIVE_IN'", 'screen_type')},
         {damaged('bad theatre', 'k', 3, '0', 'seat_capacity')}
  FROM (SELECT *, theatre_id AS k FROM theatres))"""

FAULTY_MOVIES = f"""{MOVIES},
faulty_movies AS (
  SELECT {damaged('bad movie', 'k', 0, 'NULL', 'movie_id')}, {damaged('bad movie', 'k', 1, 'NULL', 'title')},
         {damaged('bad movie', 'k', 3, 'NULL', 'genre')}, {damaged('bad movie', 'k', 2, '-1', 'duration_minutes')},
         release_date
  FROM (SELECT *, movie_id AS k FROM movies))"""

FAULTY_SHOWS = f"""{SHOWS},
faulty_shows AS (
  SELECT {damaged('bad show', 'k', 0, 'NULL', 'show_id')}, {damaged('bad show', 'k', 2, '-1', 'movie_id')},
         {damaged('bad show', 'k', 3, '-1', 'theatre_id')}, showtime, screen_type,
         {damaged('bad show', 'k', 1, '-base_price', 'base_price')}
  FROM (SELECT *, show_id AS k FROM shows))"""

EMAIL = r"'^[^@\s]+@[^@\s]+\.[^@\s]+$'"
EMAIL_OK = f"regexp_matches(email, {EMAIL})"
PHONE_OK = "regexp_matches(phone, '^[0-9]{10}$')"

REVENUE_MEASURES = f"""
  CAST(sum(net_revenue) FILTER (WHERE {REALIZED}) AS BIGINT) AS "Total Revenue",
  count(*) AS "Total Bookings",
  count(*) FILTER (WHERE payment_status = 'success') AS "Successful Bookings",
  count(*) FILTER (WHERE payment_status = 'failed') AS "Failed Bookings",
  round(sum(ticket_amount) FILTER (WHERE {REALIZED})::DOUBLE
    / nullif(count(*) FILTER (WHERE {REALIZED}), 0), 6) AS "Average Ticket Price",
  round(count(*) FILTER (WHERE is_cancelled)::DOUBLE / count(*), 6) AS "Cancellation Rate",
  count(DISTINCT customer_id) AS "Unique Customers" """

FAILURE_RATE = """round(count(*) FILTER (WHERE payment_status = 'failed')::DOUBLE / count(*), 6)
    AS "Payment Failure Rate" """

HEALTH_MEASURES = f"""
  count(*) AS "Total Bookings", count(*) FILTER (WHERE payment_status = 'failed') AS "Failed Bookings",
  {FAILURE_RATE}"""

OCCUPANCY_MEASURES = """
  count(*) AS "Show Count", CAST(sum(seat_capacity) AS BIGINT) AS "Total Seat Capacity",
  CAST(sum(seats_sold) AS BIGINT) AS "Total Seats Sold",
  round(sum(seats_sold)::DOUBLE / sum(seat_capacity), 6) AS "Occupancy Rate" """

SPENDERS = f"""{FACT},
spend AS (
  SELECT customer_id, sum(net_revenue) AS spend, count(booking_id) AS n
  FROM fact WHERE {REALIZED} GROUP BY customer_id)"""

EARNERS = f"""{FACT},
earned AS (
  SELECT movie_id, sum(net_revenue) AS revenue, count(booking_id) AS n, sum(seats_booked) AS seats
  FROM fact WHERE {REALIZED} GROUP BY movie_id)"""

WEIGHTED = f"""
weights AS (
  SELECT p_partkey AS movie_id,
    CAST(floor(pow(CAST(concat('0x', substr(sha256(printf('MOV-%05d', p_partkey + 1)), 1, 8)) AS UBIGINT)::DOUBLE
      / 4294967295.0::DOUBLE, 4) * 1000000) AS BIGINT) AS weight
  FROM part),
shares AS (
  SELECT movie_id, (running - weight)::DOUBLE / total AS lo, running::DOUBLE / total AS hi
  FROM (SELECT *, CAST(sum(weight) OVER (ORDER BY movie_id) AS BIGINT) AS running,
               CAST(sum(weight) OVER () AS BIGINT) AS total FROM weights))"""

RANGE_JOIN = f"""WITH {WEIGHTED}
SELECT o_orderkey, movie_id
FROM (SELECT o_orderkey, {draw('movie pick', 'o_orderkey')} AS position FROM orders)
JOIN shares ON position >= lo AND position < hi"""


def _counts(dataset: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, '{action}' AS action, "
        f"count(*) FILTER (WHERE {ok}) AS passed, count(*) - count(*) FILTER (WHERE {ok}) AS failed FROM {table}"
        for name, action, ok in rules
    )


BOOKING_OK = {
    "valid_booking_id": "booking_id IS NOT NULL",
    "valid_ticket_amount": "ticket_amount >= 0",
    "valid_payment_status": "payment_status IN ('success', 'failed', 'refunded')",
}


def _pick(words: tuple[str, ...], key: str, slot: int) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_extract([{listed}], 1 + CAST(floor({draw('pseudonym', key, slot=slot)} * {len(words)}) AS INTEGER))"


def _pseudonyms() -> str:
    from marquee.functions import pseudonyms as p

    k = "c_custkey"
    return f"""SELECT c_custkey,
  {_pick(p.GIVEN, k, 0)} || ' ' || {_pick(p.FAMILY, k, 1)} AS person_name,
  {_pick(p.PLACES, k, 0)} || ' ' || {_pick(p.HOUSES, k, 1)} || ' Cinemas' AS theatre_name,
  {_pick(p.MOODS, k, 0)} || ' ' || {_pick(p.THINGS, k, 1)} AS movie_title,
  lower({_pick(p.GIVEN, k, 0)}) || c_custkey || '@' || {_pick(p.MAIL_HOSTS, k, 1)} AS email,
  '9' || lpad(CAST(CAST(floor({draw('pseudonym', k)} * 1000000000) AS BIGINT) AS VARCHAR), 9, '0') AS phone
FROM customer"""


def _normal(salt: str, key: str) -> str:
    first, second = draw(salt, key), draw(salt, key, slot=1)
    return f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {first})) * cos(2.0::DOUBLE * pi() * {second})"


FEED_OUT = """booking_id, show_id, customer_id, seats_booked, ticket_amount, fees, discount, payment_gateway,
  payment_status, booking_channel, is_cancelled, booking_date, _ingested_at"""

ORACLES: dict[str, str] = {
    "bronze_ingest": "SELECT *, TRUE AS has_lineage, 'lineitem.parquet' AS file FROM lineitem",
    "bronze_stream": "SELECT *, TRUE AS has_lineage, 'lineitem.parquet' AS file FROM lineitem",
    "bronze_stream_batches": """SELECT *, CASE WHEN l_orderkey % 3 = 2 THEN l_orderkey END AS promo_code,
          TRUE AS has_lineage FROM lineitem""",
    "landed_history": "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem",
    "landed_row_count": " UNION ALL ".join(
        f"SELECT '{t}' AS entity, count(*) AS landed_rows FROM {t}"
        for t in ("customer", "orders", "lineitem", "part", "supplier")
    ),
    "row_source_range": """SELECT o_orderkey, i - 1 AS id, printf('BKG-%08d', i) AS booking_id
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders)""",
    "lookup_inline": "SELECT c_custkey, substr(c_mktsegment, 1, 2) AS code FROM customer",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
          CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
          CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
          CAST(day(d) AS INTEGER) AS day_of_month, strftime(d, '%A') AS day_name,
          dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series(m - INTERVAL 1095 DAY, m + INTERVAL 730 DAY, INTERVAL 1 DAY)) AS d
              FROM (SELECT CAST(max(o_orderdate) AS DATE) AS m FROM orders))""",
    "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "dim_movie": f"WITH {MOVIES} SELECT * FROM movies",
    "dim_show": f"WITH {SHOWS} SELECT * FROM shows",
    "dim_theatre": f"WITH {THEATRES} SELECT * FROM theatres",
    "rename_projection": """SELECT o_orderkey AS global_id, o_custkey AS customer_id,
        o_orderdate AS booking_date FROM orders""",
    "realized_filter": f"""WITH {FEED} SELECT booking_id, ticket_amount + fees - discount AS net_revenue,
        _ingested_at FROM feed WHERE {REALIZED}""",
    "compound_predicate": f"""WITH {FEED} SELECT booking_id, seats_booked, payment_gateway, booking_date,
        is_cancelled, ticket_amount FROM feed
        WHERE (seats_booked >= 40 AND payment_gateway <> '1-URGENT')
           OR (booking_date < DATE '1997-01-01' AND payment_gateway = '1-URGENT' AND NOT is_cancelled)""",
    "dq_theatres": f"""WITH {FAULTY_THEATRES} SELECT * FROM faulty_theatres WHERE theatre_id IS NOT NULL
        AND city IS NOT NULL AND state IS NOT NULL
        AND screen_type IN ('STANDARD', 'PREMIUM', 'IMAX', 'RECLINER') AND seat_capacity > 0""",
    "dq_movies": f"""WITH {FAULTY_MOVIES} SELECT * FROM faulty_movies WHERE movie_id IS NOT NULL
        AND title IS NOT NULL AND duration_minutes > 0 AND genre IS NOT NULL""",
    "dq_shows": f"""WITH {FAULTY_SHOWS} SELECT * FROM faulty_shows
        WHERE show_id IS NOT NULL AND base_price >= 0""",
    "dq_customers": f"""WITH {CUSTOMERS} SELECT *, concat_ws(',',
          CASE WHEN NOT {EMAIL_OK} THEN 'valid_email_format' END,
          CASE WHEN NOT {PHONE_OK} THEN 'valid_phone_format' END) AS broken
        FROM customers WHERE customer_id IS NOT NULL""",
    "dq_bookings": f"""WITH {FAULTY_FEED} SELECT {FEED_OUT} FROM faulty
        WHERE {' AND '.join(BOOKING_OK.values())}""",
    "dq_violation_counts": f"""WITH {FAULTY_THEATRES}, {FAULTY_MOVIES}, {FAULTY_SHOWS}, {CUSTOMERS}, {REFERENCED} """
    + " UNION ALL ".join(
        [
            _counts("theatres", "faulty_theatres", [
                ("valid_theatre_id", "drop", "theatre_id IS NOT NULL"),
                ("valid_location", "drop", "city IS NOT NULL AND state IS NOT NULL"),
                ("valid_screen_type", "drop", "screen_type IN ('STANDARD', 'PREMIUM', 'IMAX', 'RECLINER')"),
                ("valid_seat_capacity", "drop", "seat_capacity > 0")]),
            _counts("movies", "faulty_movies", [
                ("valid_movie_id", "drop", "movie_id IS NOT NULL"),
                ("valid_title", "drop", "title IS NOT NULL"),
                ("valid_duration", "drop", "duration_minutes > 0"),
                ("valid_genre", "drop", "genre IS NOT NULL")]),
            _counts("shows", "faulty_shows", [
                ("valid_show_id", "drop", "show_id IS NOT NULL"),
                ("valid_base_price", "drop", "base_price >= 0")]),
            _counts("customers", "customers", [
                ("valid_customer_id", "drop", "customer_id IS NOT NULL"),
                ("valid_email_format", "warn", EMAIL_OK),
                ("valid_phone_format", "warn", PHONE_OK)]),
            _counts("bookings", "referenced", [(n, "drop", ok) for n, ok in BOOKING_OK.items()]),
        ]
    ),
    "dq_quarantine": f"""WITH {FAULTY_FEED}, tagged AS (SELECT *, concat_ws(',', """
    + ", ".join(f"CASE WHEN NOT coalesce({ok}, FALSE) THEN '{name}' END" for name, ok in BOOKING_OK.items())
    + """) AS broken FROM faulty)
        SELECT booking_id, show_id, customer_id, ticket_amount, payment_status, broken
        FROM tagged WHERE broken <> ''""",
    "ri_shows": f"""WITH {FAULTY_SHOWS} SELECT * FROM faulty_shows
        WHERE movie_id IN (SELECT p_partkey FROM part) AND theatre_id IN (SELECT s_suppkey FROM supplier)""",
    "ri_bookings": f"WITH {REFERENCED} SELECT {FEED_OUT} FROM referenced",
    "ri_orphans": f"""WITH {FAULTY_FEED}, tagged AS (SELECT *, concat_ws(',',
          CASE WHEN show_id NOT IN (SELECT p_partkey FROM part) THEN 'show_id' END,
          CASE WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'customer_id' END) AS missing FROM faulty)
        SELECT booking_id, show_id, customer_id, ticket_amount, missing FROM tagged WHERE missing <> ''""",
    "silver_bookings": f"""WITH {REFERENCED}, placed AS (SELECT *, row_number() OVER (PARTITION BY booking_id
          ORDER BY _ingested_at DESC, show_id DESC, customer_id DESC, seats_booked DESC, ticket_amount DESC,
            fees DESC, discount DESC, payment_gateway DESC, payment_status DESC, booking_channel DESC,
            is_cancelled DESC, booking_date DESC) AS place
          FROM referenced WHERE {' AND '.join(BOOKING_OK.values())})
        SELECT {FEED_OUT} FROM placed WHERE place = 1""",
    "silver_shows": f"""WITH {FAULTY_THEATRES}, {FAULTY_MOVIES}, {FAULTY_SHOWS} SELECT * FROM faulty_shows
        WHERE show_id IS NOT NULL AND base_price >= 0
          AND movie_id IN (SELECT movie_id FROM faulty_movies WHERE movie_id IS NOT NULL
            AND title IS NOT NULL AND duration_minutes > 0 AND genre IS NOT NULL)
          AND theatre_id IN (SELECT theatre_id FROM faulty_theatres WHERE theatre_id IS NOT NULL
            AND city IS NOT NULL AND state IS NOT NULL
            AND screen_type IN ('STANDARD', 'PREMIUM', 'IMAX', 'RECLINER') AND seat_capacity > 0)""",
    "cdc_merge_bookings": f"""WITH {FEED}, placed AS (SELECT *, row_number() OVER (PARTITION BY booking_id
          ORDER BY _ingested_at DESC, show_id DESC, customer_id DESC, seats_booked DESC, ticket_amount DESC,
            fees DESC, discount DESC, payment_gateway DESC, payment_status DESC, booking_channel DESC,
            is_cancelled DESC, booking_date DESC) AS place FROM feed)
        SELECT {FEED_OUT} FROM placed WHERE place = 1""",
    "full_load_read": "SELECT * FROM orders",
    "claimed_files": "SELECT *, 2 AS claims FROM orders",
    "streaming_table_read": "SELECT * FROM orders WHERE o_totalprice > 0 AND o_orderpriority <> '1-URGENT'",
    "fixture_reader": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
    "dq_fail_rules": f"""WITH {FEED} SELECT booking_id, seats_booked, payment_status FROM feed
        WHERE payment_status = 'success'""",
    "refresh_quality_counts": f"""WITH {THEATRES}, {MOVIES}, {SHOWS}, {CUSTOMERS}, {REFERENCED} """
    + " UNION ALL ".join(
        [
            _counts("theatres", "theatres", [
                ("valid_theatre_id", "drop", "theatre_id IS NOT NULL"),
                ("valid_location", "drop", "city IS NOT NULL AND state IS NOT NULL"),
                ("valid_screen_type", "drop", "screen_type IN ('STANDARD', 'PREMIUM', 'IMAX', 'RECLINER')"),
                ("valid_seat_capacity", "drop", "seat_capacity > 0")]),
            _counts("movies", "movies", [
                ("valid_movie_id", "drop", "movie_id IS NOT NULL"), ("valid_title", "drop", "title IS NOT NULL"),
                ("valid_duration", "drop", "duration_minutes > 0"), ("valid_genre", "drop", "genre IS NOT NULL")]),
            _counts("shows", "shows", [
                ("valid_show_id", "drop", "show_id IS NOT NULL"), ("valid_base_price", "drop", "base_price >= 0")]),
            _counts("customers", "customers", [
                ("valid_customer_id", "drop", "customer_id IS NOT NULL"), ("valid_email_format", "warn", EMAIL_OK),
                ("valid_phone_format", "warn", PHONE_OK)]),
            _counts("bookings", "referenced", [(n, "drop", ok) for n, ok in BOOKING_OK.items()]),
        ]
    ),
    "metric_equals_manual": f"""WITH {WIDE} SELECT city, sum(net_revenue)::BIGINT AS metric, sum(net_revenue)::BIGINT AS manual
        FROM wide WHERE {REALIZED} GROUP BY city""",
    "filtered_payment_health": f"""WITH {WIDE} SELECT city AS "City", payment_gateway AS "Payment Gateway",
        {HEALTH_MEASURES} FROM wide
        WHERE booking_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
          AND city IN ('NATION_1', 'NATION_2', 'NATION_3') AND payment_gateway IN ('1-URGENT', '5-LOW')
        GROUP BY city, payment_gateway""",
    "filtered_occupancy": f"""WITH {OCCUPANCY} SELECT city AS "City", screen_type AS "Screen Type", {OCCUPANCY_MEASURES}
        FROM occupancy WHERE city IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY city, screen_type""",
    "cdc_latest_bookings": f"WITH {BOOKINGS} SELECT {FEED_OUT} FROM bookings",
    "cdc_latest_customers": f"""WITH {CUSTOMERS}, changes AS (
          SELECT *, TIMESTAMP '1990-01-01' AS _ingested_at, CAST(-1 AS BIGINT) AS change FROM customers
          UNION ALL
          SELECT c.customer_id, c.name, c.email, c.phone, 'NATION_' || (o_orderkey % 25) AS city, c.signup_date,
                 o_orderdate, o_orderkey FROM orders JOIN customers c ON o_custkey = c.customer_id)
        SELECT customer_id, name, email, phone, city, signup_date, _ingested_at, change
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC, change DESC) AS place
              FROM changes) WHERE place = 1""",
    "silver_customers": f"""WITH {CUSTOMERS}, changes AS (
          SELECT *, TIMESTAMP '1990-01-01' AS _ingested_at, CAST(-1 AS BIGINT) AS change FROM customers
          UNION ALL
          SELECT c.customer_id, c.name, c.email, c.phone, 'NATION_' || (o_orderkey % 25) AS city, c.signup_date,
                 o_orderdate, o_orderkey FROM orders JOIN customers c ON o_custkey = c.customer_id)
        SELECT customer_id, name, email, phone, city, signup_date, _ingested_at, change, concat_ws(',',
          CASE WHEN NOT {EMAIL_OK} THEN 'valid_email_format' END,
          CASE WHEN NOT {PHONE_OK} THEN 'valid_phone_format' END) AS broken
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC, change DESC) AS place
              FROM changes) WHERE place = 1 AND customer_id IS NOT NULL""",
    "fact_bookings": f"WITH {FACT} SELECT * FROM fact",
    "show_occupancy": f"""WITH {OCCUPANCY} SELECT * EXCLUDE (theatre_name)
        REPLACE (round(occupancy_rate, 6) AS occupancy_rate) FROM occupancy""",
    "customer_spend": f"""WITH {SPENDERS} SELECT customer_id, CAST(spend AS BIGINT) AS lifetime_spend,
        n AS lifetime_bookings FROM spend""",
    "dim_customer": f"""WITH {SPENDERS}, {CUSTOMERS}, filled AS (
          SELECT c.*, CAST(coalesce(spend, 0) AS BIGINT) AS lifetime_spend, coalesce(n, 0) AS lifetime_bookings
          FROM customers c LEFT JOIN spend USING (customer_id))
        SELECT *, CASE ntile(4) OVER (ORDER BY lifetime_spend DESC, customer_id)
          WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'Bronze' END AS loyalty_segment
        FROM filled""",
    "movie_performance": f"""WITH {EARNERS}, {MOVIES}, filled AS (
          SELECT m.*, CAST(coalesce(revenue, 0) AS BIGINT) AS total_revenue, coalesce(n, 0) AS total_bookings,
                 CAST(coalesce(seats, 0) AS BIGINT) AS total_seats_sold
          FROM movies m LEFT JOIN earned USING (movie_id)),
        placed AS (SELECT *, percent_rank() OVER (ORDER BY total_revenue) AS p FROM filled)
        SELECT * EXCLUDE (p), CASE WHEN p >= 0.8 THEN 'hit' WHEN p >= 0.4 THEN 'steady'
          ELSE 'underperforming' END AS performance_tier FROM placed""",
    "daily_revenue_summary": f"""WITH {FACT}, {THEATRES}
        SELECT date_key, booking_date, city, payment_gateway,
          CAST(coalesce(sum(net_revenue) FILTER (WHERE {REALIZED}), 0) AS BIGINT) AS total_revenue,
          count(booking_id) AS total_bookings,
          count(*) FILTER (WHERE payment_status = 'success') AS successful_bookings,
          count(*) FILTER (WHERE payment_status = 'failed') AS failed_bookings,
          count(*) FILTER (WHERE payment_status = 'refunded') AS refunded_bookings,
          count(*) FILTER (WHERE is_cancelled) AS cancelled_bookings,
          count(DISTINCT customer_id) AS unique_customers,
          round(count(*) FILTER (WHERE payment_status = 'failed')::DOUBLE / count(*), 6) AS payment_failure_rate,
          round(count(*) FILTER (WHERE is_cancelled)::DOUBLE / count(*), 6) AS cancellation_rate
        FROM fact JOIN theatres USING (theatre_id) GROUP BY date_key, booking_date, city, payment_gateway""",
    "ntile_distributed": f"""WITH {SPENDERS}, filled AS (
          SELECT c_custkey AS customer_id, CAST(coalesce(spend, 0) AS BIGINT) AS lifetime_spend,
                 coalesce(n, 0) AS lifetime_bookings
          FROM customer LEFT JOIN spend ON c_custkey = customer_id)
        SELECT *, CAST(ntile(4) OVER (ORDER BY lifetime_spend DESC, customer_id) AS INTEGER) AS quartile FROM filled""",
    "percent_rank_distributed": f"""WITH {EARNERS}, filled AS (
          SELECT p_partkey AS movie_id, CAST(coalesce(revenue, 0) AS BIGINT) AS total_revenue,
                 coalesce(n, 0) AS total_bookings, CAST(coalesce(seats, 0) AS BIGINT) AS total_seats_sold
          FROM part LEFT JOIN earned ON p_partkey = movie_id)
        SELECT *, round(percent_rank() OVER (ORDER BY total_revenue), 6) AS percentile FROM filled""",
    "metric_booking_revenue": f"""WITH {WIDE} SELECT city AS "City", genre AS "Genre",
        payment_gateway AS "Payment Gateway", {REVENUE_MEASURES} FROM wide GROUP BY city, genre, payment_gateway""",
    "metric_booking_revenue_by_title": f"""WITH {WIDE} SELECT title AS "Movie Title",
        theatre_name AS "Theatre Name", booking_channel AS "Booking Channel", {REVENUE_MEASURES}
        FROM wide GROUP BY title, theatre_name, booking_channel""",
    "metric_payment_health": f"""WITH {WIDE} SELECT payment_gateway AS "Payment Gateway", city AS "City",
        booking_date AS "Booking Date", {HEALTH_MEASURES} FROM wide GROUP BY payment_gateway, city, booking_date""",
    "metric_theatre_occupancy": f"""WITH {OCCUPANCY} SELECT theatre_name AS "Theatre Name", city AS "City",
        screen_type AS "Screen Type", show_date AS "Show Date", {OCCUPANCY_MEASURES}
        FROM occupancy GROUP BY theatre_name, city, screen_type, show_date""",
    "filtered_revenue": f"""WITH {WIDE} SELECT city AS "City", payment_gateway AS "Payment Gateway",
        {REVENUE_MEASURES} FROM wide
        WHERE booking_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
          AND city IN ('NATION_1', 'NATION_2', 'NATION_3') AND payment_gateway IN ('1-URGENT', '5-LOW')
        GROUP BY city, payment_gateway""",
    "kpi_counters": f"WITH {FACT} SELECT {REVENUE_MEASURES} FROM fact",
    "weekly_revenue_trend": f"""WITH {FACT} SELECT CAST(date_trunc('week', booking_date) AS DATE) AS "Week",
        CAST(sum(net_revenue) FILTER (WHERE {REALIZED}) AS BIGINT) AS "Total Revenue" FROM fact GROUP BY 1""",
    "payment_health_rollup": f"""WITH {WIDE} SELECT payment_gateway AS "Payment Gateway", city AS "City",
        booking_date AS "Booking Date", CAST(grouping(payment_gateway, city, booking_date) AS BIGINT) AS grouping_id,
        {HEALTH_MEASURES} FROM wide
        GROUP BY GROUPING SETS ((), (payment_gateway), (city), (booking_date))""",
    "failure_rate_by_date_gateway": f"""WITH {FACT} SELECT booking_date AS "Booking Date",
        payment_gateway AS "Payment Gateway", {FAILURE_RATE} FROM fact GROUP BY booking_date, payment_gateway""",
    "city_gateway_heatmap": f"""WITH {WIDE} SELECT city AS "City", payment_gateway AS "Payment Gateway",
        count(*) AS "Total Bookings", {FAILURE_RATE} FROM wide GROUP BY city, payment_gateway""",
    "city_gateway_grid": f"""WITH {WIDE} SELECT city AS "City", """
    + ", ".join(
        f"""round(count(*) FILTER (WHERE payment_status = 'failed' AND payment_gateway = '{g}')::DOUBLE
          / nullif(count(*) FILTER (WHERE payment_gateway = '{g}'), 0), 6) AS "{g}" """
        for g in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + "FROM wide GROUP BY city",
    "worst_payment_slices": f"""WITH {WIDE} SELECT payment_gateway AS "Payment Gateway", city AS "City",
        {HEALTH_MEASURES} FROM wide GROUP BY payment_gateway, city HAVING count(*) >= 20
        ORDER BY count(*) FILTER (WHERE payment_status = 'failed')::DOUBLE / count(*) DESC, count(*) DESC, 1, 2
        LIMIT 15""",
    "worst_payment_slices_by_quarter": f"""WITH {WIDE}, q AS (
          SELECT *, CAST(date_trunc('quarter', booking_date) AS DATE) AS quarter FROM wide)
        SELECT payment_gateway AS "Payment Gateway", city AS "City", quarter AS "Booking Date", {HEALTH_MEASURES}
        FROM q GROUP BY payment_gateway, city, quarter HAVING count(*) >= 20
        ORDER BY count(*) FILTER (WHERE payment_status = 'failed')::DOUBLE / count(*) DESC, count(*) DESC, 1, 2, 3
        LIMIT 15""",
    "revenue_by_city": f"""WITH {WIDE} SELECT city AS "City",
        CAST(sum(net_revenue) FILTER (WHERE {REALIZED}) AS BIGINT) AS "Total Revenue", count(*) AS "Total Bookings"
        FROM wide GROUP BY city""",
    "channel_split": f"""WITH {FACT} SELECT booking_channel AS "Booking Channel",
        CAST(sum(net_revenue) FILTER (WHERE {REALIZED}) AS BIGINT) AS "Total Revenue", count(*) AS "Total Bookings"
        FROM fact GROUP BY booking_channel""",
    "top_movies": f"""WITH {WIDE} SELECT title AS "Movie Title",
        CAST(sum(net_revenue) FILTER (WHERE {REALIZED}) AS BIGINT) AS "Total Revenue" FROM wide
        GROUP BY title ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10""",
    "occupancy_by_screen": f"""WITH {OCCUPANCY} SELECT screen_type AS "Screen Type", {OCCUPANCY_MEASURES}
        FROM occupancy GROUP BY screen_type""",
    "occupancy_by_city": f"""WITH {OCCUPANCY} SELECT city AS "City", {OCCUPANCY_MEASURES}
        FROM occupancy GROUP BY city""",
    "failure_rate_status": f"""WITH {WIDE}, rates AS (
          SELECT city, payment_gateway, count(*) FILTER (WHERE payment_status = 'failed')::DOUBLE / count(*) AS r
          FROM wide GROUP BY city, payment_gateway)
        SELECT city AS "City", payment_gateway AS "Payment Gateway", round(r, 6) AS "Payment Failure Rate",
          CASE WHEN r >= 0.36 THEN 'red' WHEN r >= 0.33 THEN 'amber' ELSE 'green' END AS "Status" FROM rates""",
    "broadcast_lookup": """SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank,
        count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM orders GROUP BY 1""",
    "range_bucket_join": RANGE_JOIN,
    "range_bucket_join_distributed": RANGE_JOIN,
    "union_by_name": """SELECT c_name AS name, c_nationkey AS nation FROM customer
        UNION ALL SELECT s_name, s_nationkey FROM supplier""",
    "hash_sample": f"SELECT * FROM orders WHERE {draw('sample', 'o_orderkey')} < 0.1",
    "hash_uniform": f"""SELECT o_orderkey, round({draw('uniform', 'o_orderkey')}, 9) AS first,
        round({draw('uniform', 'o_orderkey', slot=7)}, 9) AS last FROM orders""",
    "popularity_weight": """SELECT movie_id, round(pow(CAST(concat('0x', substr(sha256(movie_id), 1, 8)) AS UBIGINT)::DOUBLE
          / 4294967295.0::DOUBLE, 4), 9) AS weight
        FROM (SELECT printf('MOV-%05d', p_partkey + 1) AS movie_id FROM part)""",
    "weighted_category": f"""SELECT o_orderkey,
          CASE WHEN d < 0.55 THEN 0 WHEN d < 0.9 THEN 1 ELSE 2 END AS channel_index,
          CASE WHEN d < 0.55 THEN 'mobile_app' WHEN d < 0.9 THEN 'web' ELSE 'box_office' END AS channel
        FROM (SELECT o_orderkey, {draw('channel', 'o_orderkey')} AS d FROM orders)""",
    "uniform_fk": f"""SELECT o_orderkey,
        CAST(floor({draw('show pick', 'o_orderkey')} * (SELECT count(*) FROM part)) AS BIGINT) AS show_id FROM orders""",
    "skewed_fk": f"""SELECT o_orderkey, CAST(floor(pow({draw('customer pick', 'o_orderkey')}, 3)
        * (SELECT count(*) FROM customer)) AS BIGINT) AS customer_id FROM orders""",
    "date_spread": f"""SELECT o_orderkey,
          CAST(o_orderdate AS DATE) + {whole(f"{draw('days', 'o_orderkey')} * 181")} AS spread_day,
          CAST(o_orderdate AS DATE) + {whole(f"pow({draw('days', 'o_orderkey', slot=1)}, 2) * -1095")} AS recent_day
        FROM orders""",
    "clamped_normal": f"""SELECT o_orderkey,
        greatest(80, least(220, {whole(f"130.0::DOUBLE + 20.0::DOUBLE * ({_normal('duration', 'o_orderkey')})")}))
          AS duration_minutes FROM orders""",
    "incident_overlay": f"""WITH {FACT}, {THEATRES} SELECT booking_id, payment_gateway, city, booking_date,
          CASE WHEN payment_gateway = '1-URGENT' AND city IN ('NATION_1', 'NATION_5')
                 AND booking_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
               THEN CASE WHEN {draw('incident', 'booking_id')} < 0.88 THEN 'failed' ELSE 'success' END
               ELSE payment_status END AS payment_status
        FROM fact JOIN theatres USING (theatre_id)""",
    "fault_injection": f"WITH {FAULTY_FEED} SELECT {FEED_OUT} FROM faulty",
    "id_continuation": """SELECT s_suppkey, printf('CUST-%07d', (SELECT count(*) FROM customer)
        + row_number() OVER (ORDER BY s_suppkey)) AS customer_id FROM supplier""",
    "pseudonymize": _pseudonyms(),
    "scalar_strings": """SELECT c_custkey, printf('CUST-%07d', c_custkey + 1) AS customer_id,
        lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS padded,
        c_mktsegment || ' ' || printf('%02d:00:00', c_nationkey) AS slot,
        regexp_matches(c_name, '^Customer#[0-9]{8}[02468]$') AS even_name FROM customer""",
    "scalar_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 730 AS later,
        CAST(o_orderdate AS DATE) - 1095 AS earlier, CAST(o_orderdate AS DATE) AS order_day,
        CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 13 HOUR AS at_one,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday,
        CAST(date_trunc('week', o_orderdate) AS DATE) AS week FROM orders""",
    "scalar_math": """SELECT c_custkey, CAST(floor(c_acctbal / 7) AS BIGINT) AS floored,
        CAST(trunc(c_acctbal) AS INTEGER) AS truncated,
        greatest(80, least(220, CAST(trunc(c_acctbal) AS INTEGER))) AS clamped,
        round(pow(c_acctbal / 10000, 3), 6) AS cubed,
        CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0 END AS non_negative,
        CASE WHEN c_acctbal > 5000 THEN c_acctbal / 2.0 END AS halved,
        CAST(c_custkey AS VARCHAR) AS as_text FROM customer""",
}
ORACLES["clustered_lines"] = "SELECT l_suppkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey"
ORACLES["weight_thresholds"] = """SELECT o_orderpriority, round(sum(n) OVER (ORDER BY o_orderpriority)::DOUBLE / sum(n) OVER (), 6) AS upto
    FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)"""
ORACLES["metric_comments"] = f"""WITH {WIDE}, c AS (SELECT CAST(count(DISTINCT coalesce(city, '')) AS INTEGER) AS cities FROM wide)
    SELECT * FROM (VALUES ('City', 'City of the theatre'), ('Total Bookings', 'All bookings'),
      ('Failed Bookings', 'Bookings whose payment failed'), ('Payment Failure Rate', 'Failed bookings over all bookings'))
      AS t(name, comment), c"""
ORACLES["kpi_counters_from_rollup"] = ORACLES["kpi_counters"]
ORACLES["heatmap_from_rollup"] = ORACLES["city_gateway_heatmap"]
ORACLES["unique_customers_from_partials"] = f"""WITH {WIDE}
    SELECT 'day' AS level, CAST(booking_date AS VARCHAR) AS slice, count(DISTINCT customer_id) AS customers FROM wide GROUP BY 2
    UNION ALL SELECT 'city', coalesce(city, ''), count(DISTINCT customer_id) FROM wide GROUP BY 2
    UNION ALL SELECT 'all', '', count(DISTINCT customer_id) FROM wide"""
ORACLES["incremental_equals_full"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS stored_rows, CAST(0 AS BIGINT) AS differing, "
    f"CAST(sum({total}) AS BIGINT) AS total FROM ({rows})"
    for table, total, rows in (
        ("dim_theatre", "0", ORACLES["dim_theatre"]), ("dim_movie", "0", ORACLES["dim_movie"]),
        ("dim_show", "0", ORACLES["dim_show"]), ("dim_date", "0", "SELECT unnest(range(0, 1826))"),
        ("fact_bookings", "net_revenue", ORACLES["fact_bookings"]),
        ("dim_customer", "lifetime_spend * length(loyalty_segment)", ORACLES["dim_customer"]),
        ("fact_show_occupancy", "seats_sold", ORACLES["show_occupancy"]),
        ("agg_movie_performance", "total_revenue * length(performance_tier)", ORACLES["movie_performance"]),
        ("agg_daily_revenue_summary", "total_revenue + unique_customers", ORACLES["daily_revenue_summary"]),
    )
)
