"""SQL definitions of the order-dependent selections, for the oracles."""

from __future__ import annotations

NEAR = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


def turns(rows: str, rank: str, within: str, stops: str = "true") -> str:
    """``turn`` (columns of ``rows``, ``n``): the rows that stay when each gives way to better-ranked ones that stay and are near.

    A fixpoint: a row stays once every row that could stop it is known to give way.
    ``within`` compares the distance; ``stops`` may refer to the row ``a`` and the better one ``b``.
    """
    return f"""ordered AS (SELECT *, row_number() OVER (ORDER BY {rank}) AS n FROM ({rows}) r),
    stopper AS (SELECT a.n, b.n AS by FROM ordered a JOIN ordered b ON b.n < a.n AND {NEAR} {within} AND ({stops})),
    walk AS (SELECT 0 AS t, n, 0 AS state FROM ordered
      UNION ALL SELECT w.t + 1, w.n, CASE WHEN any_value(w.state) > 0 THEN any_value(w.state) WHEN bool_or(coalesce(b.state = 1, false)) THEN 2
        WHEN bool_and(coalesce(b.state = 2, true)) THEN 1 ELSE 0 END
      FROM walk w LEFT JOIN stopper s ON s.n = w.n LEFT JOIN walk b ON b.n = s.by
      WHERE EXISTS (SELECT 1 FROM walk u WHERE u.state = 0) GROUP BY w.t, w.n),
    turn AS (SELECT * FROM ordered WHERE n IN (SELECT n FROM walk WHERE state = 1))"""


def detection_turns(table: str, radius: float) -> str:
    """``walk``: detections by id; a turn ends at the first more confident row still there and removes the ones before it."""
    return f"""later AS MATERIALIZED (SELECT a.det_id, list({{'id': b.det_id, 'more': b.mean_confidence > a.mean_confidence}} ORDER BY b.det_id) AS near
      FROM {table} a JOIN {table} b ON b.det_id > a.det_id AND {NEAR} <= {radius} GROUP BY a.det_id),
    steps AS MATERIALIZED (SELECT det_id, near, row_number() OVER (ORDER BY det_id) AS n FROM later),
    walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS gone
      UNION ALL SELECT n, list_concat(gone, CASE WHEN list_contains(gone, det_id) THEN []
          WHEN stop IS NULL THEN list_transform(there, lambda x: x.id)
          ELSE list_append(list_transform(list_filter(there, lambda x: x.id < stop), lambda x: x.id), det_id) END)
      FROM (SELECT n, gone, det_id, there, list_filter(there, lambda x: x.more)[1].id AS stop
        FROM (SELECT s.n, w.gone, s.det_id, list_filter(s.near, lambda x: NOT list_contains(w.gone, x.id)) AS there
          FROM walk w JOIN steps s ON s.n = w.n + 1) a) b)"""


DETECTION_TURNS = detection_turns("fx_detections", 100)
