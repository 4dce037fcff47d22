"""Window rule, clocks, area, ladders and the repeat-order chain in DuckDB SQL."""

from __future__ import annotations

# Run date and window-rule values used by every registered query (they match
# tandem.plans.params.FIXTURE_PARAMS).
AS_OF = "DATE '2001-08-02'"
CUTOFF = "DATE '2000-12-31'"
REFUNDS_CUTOFF = "DATE '2001-06-02'"
FLOOR = "DATE '1995-01-01'"


def window_sql(cutoff: str = CUTOFF) -> tuple[str, str]:
    year_ago = f"CAST({AS_OF} - INTERVAL 1 YEAR AS DATE)"
    week = f"({year_ago} - CAST(dayofweek({year_ago}) AS INTEGER))"
    start = (f"(CASE WHEN {week} <= {cutoff} THEN {FLOOR} "
             f"ELSE CAST({AS_OF} - INTERVAL 3 MONTH AS DATE) END)")
    end = f"CAST({AS_OF} - INTERVAL 1 DAY AS DATE)"
    return start, end


START, END = window_sql()
R_START, R_END = window_sql(REFUNDS_CUTOFF)

ORD = ["first", "second", "third", "fourth"]


def chain_sql(where: str = "") -> str:
    """The relation ``next_orders``: each delivered delivery of the window with its
    customer's next four orders.  ``where`` narrows the deliveries."""
    following = {"id": "sys_delivery_id", "date": "order_date", "sub": "food_subtotal"}
    leads = ", ".join(f"lead({col}, {n}) OVER later AS {tag}_{n}" for n in range(1, 5) for tag, col in following.items())
    named, since, since_name = ["sys_delivery_id"], "order_date", "current_order"
    for n, name in enumerate(ORD, 1):
        named += [f"id_{n} AS {name}_reorder_sys_delivery_id",
                  f"CAST(date_diff('day', {since}, date_{n}) AS BIGINT) AS days_between_{since_name}_and_{name}_reorder",
                  f"sub_{n} AS {name}_reorder_food_subtotal"]
        since, since_name = f"date_{n}", f"{name}_reorder"
    return f""",
next_orders AS (
  SELECT {', '.join(named)} FROM (
    SELECT d.sys_delivery_id, o.order_date, {leads}
    FROM fact_orders_resto o JOIN fact_deliveries d USING (sys_order_id)
    WHERE d.delivery_status = 'DELIVERED' AND o.order_date BETWEEN {START} AND {END} {where}
    WINDOW later AS (PARTITION BY d.tenant_id, o.sys_custo_id ORDER BY o.order_datetime NULLS FIRST, d.sys_delivery_id))
)"""


def _near() -> str:
    gaps = [f"days_between_{a}_and_{b}_reorder" for a, b in zip(
        ("current_order", *(f"{n}_reorder" for n in ORD)), ORD)]
    return " AND ".join([f"{gaps[0]} <= 60", *(f"coalesce({g} <= 60, TRUE)" for g in gaps[1:])])


REORDER_CTES = chain_sql("AND d.tenant_id = 'ie'") + f""",
reorder_info AS (SELECT * FROM next_orders WHERE {_near()})"""


def utc(ts: str, tz: str = "timezone") -> str:
    """Local wall time in zone tz -> UTC wall time.

    A local time that occurs twice (clocks going back) resolves to the earlier
    instant, as the warehouse dialect and Spark do; DuckDB's ICU picks the
    later one, so the earlier is chosen explicitly (the zones used shift by
    whole hours).  Non-existent local times agree in both engines.
    """
    first = f"timezone({tz}, {ts})"
    earlier = f"({first} - INTERVAL 1 HOUR)"
    pick = f"(CASE WHEN timezone({tz}, {earlier}) = {ts} THEN {earlier} ELSE {first} END)"
    return f"timezone('UTC', {pick})"


def local(ts: str, tz: str) -> str:
    """UTC wall time -> wall time in zone tz."""
    return f"timezone({tz}, timezone('UTC', {ts}))"


def sec(end: str, start: str) -> str:
    return f"date_diff('second', {start}, {end})"


def ms_trunc(end: str, start: str) -> str:
    return f"trunc(date_diff('millisecond', {start}, {end}) / 1000)"


def area_km2(ring: str) -> str:
    """Area inside a closed ring of great-circle edges: the solid angles of the triangles
    that its first corner makes with each edge, by the corners' unit vectors."""
    def dot(a: str, b: str) -> str:
        return f"({a}[1] * {b}[1] + {a}[2] * {b}[2] + {a}[3] * {b}[3])"

    a, b, c = "v[1]", "v[i]", "v[i + 1]"
    volume = " + ".join(f"{a}[{i}] * ({b}[{j}] * {c}[{k}] - {b}[{k}] * {c}[{j}])" for i, j, k in ((1, 2, 3), (2, 3, 1), (3, 1, 2)))
    triangle = f"2 * atan2({volume}, 1 + {dot(a, b)} + {dot(b, c)} + {dot(c, a)})"
    corners = (f"list_transform({ring}, lambda p: [cos(radians(p.lat)) * cos(radians(p.lon)), "
               f"cos(radians(p.lat)) * sin(radians(p.lon)), sin(radians(p.lat))])")
    angle = f"list_transform([{corners}], lambda v: abs(list_sum(list_transform(range(2, len(v) - 1), lambda i: {triangle}))))[1]"
    return f"(least({angle}, 4 * pi() - {angle}) * 6371010.0 * 6371010.0 / 1000000)"


# The report ladders below have these limits and labels.
def slack_bin(x: str) -> str:
    return f"""CASE WHEN {x} < 0 THEN 'Early'
             WHEN {x} BETWEEN 0 AND 10 THEN '0 to 10 Mins'
             WHEN {x} BETWEEN 11 AND 15 THEN '11 to 15 Mins'
             WHEN {x} BETWEEN 16 AND 20 THEN '16 to 20 Mins'
             WHEN {x} BETWEEN 21 AND 25 THEN '21 to 25 Mins'
             WHEN {x} BETWEEN 26 AND 30 THEN '26 to 30 Mins'
             WHEN {x} BETWEEN 30 AND 40 THEN '30 to 40 Mins'
             WHEN {x} > 40 THEN '>40 Mins'
             ELSE ' N/A' END"""


def daypart(ts: str) -> str:
    h = f"hour({ts})"
    return (f"CASE WHEN {h} BETWEEN 7 AND 10 THEN 'Breakfast' WHEN {h} BETWEEN 11 AND 15 THEN 'Lunch' "
            f"WHEN {h} BETWEEN 16 AND 19 THEN 'Dinner' WHEN {h} BETWEEN 20 AND 23 THEN 'After-Dinner' "
            f"WHEN {h} BETWEEN 0 AND 6 THEN 'Overnight' END")


def eight_ranges(x: str, unit: str, top: str, last_lo: int = 18, last_hi: int = 20, gt: int = 20,
                 guard: str = "", default: str = "") -> str:
    g = f" AND {guard}" if guard else ""
    parts = [f"WHEN {x} BETWEEN {lo} AND {hi}{g} THEN '{lo} to {hi} {unit}'"
             for lo, hi in ((0, 2), (3, 5), (6, 8), (9, 11), (12, 14), (15, 17))]
    parts.append(f"WHEN {x} BETWEEN {last_lo} AND {last_hi}{g} THEN '{last_lo} to {last_hi} {unit}'")
    parts.append(f"WHEN {x} > {gt}{g} THEN '{top}'")
    tail = f" ELSE '{default}'" if default else ""
    return "CASE " + " ".join(parts) + tail + " END"
