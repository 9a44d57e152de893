"""The catalog's queries as plain SQL over the same tables, for cross-checking."""

from __future__ import annotations

from collections.abc import Sequence

from tallyrec.config import VoteParams
from tallyrec.plans.catalog import EVENTS_LIST, FRACTIONS, STABILITY_SEEDS
from tallyrec.sources.fixtures import EVENTS_CUT, ORDERS_CUT, ORDERS_SMALL_CUT

BETAS = VoteParams().betas

ORDERS = f"""log AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '{ORDERS_CUT}' THEN 'train' ELSE 'test' END AS kind,
         o_custkey AS user_id, l_partkey AS item_id, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
EVENTS = f"""log AS (
  SELECT CASE WHEN ts < TIMESTAMP '{EVENTS_CUT}' THEN 'train' ELSE 'test' END AS kind,
         user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts
  FROM events)"""
TRACKS = """tracks AS (
  SELECT p_partkey AS item_id, concat('m-', p_partkey) AS recording_msid,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN ''
              ELSE concat(p_name, '|', p_brand) END AS recording_mbid,
         p_name AS track_name, p_brand AS artist_name
  FROM part)"""
COUNTS = """counts AS (
  SELECT kind, user_id, item_id, count(*) AS n FROM log GROUP BY kind, user_id, item_id),
activity AS (
  SELECT kind, user_id, count(DISTINCT item_id) AS items, count(*) AS pairs
  FROM counts GROUP BY kind, user_id)"""


def _key(prefix: str) -> str:
    return f"substr(md5(concat({prefix}, '|', user_id, '|', item_id)), 1, 16)"


FOLDED = f"""folded AS (
  SELECT *, count(*) OVER (PARTITION BY kind, user_id) AS size,
         ntile(5) OVER (PARTITION BY kind, user_id ORDER BY {_key("'10'")}, item_id) AS fold
  FROM counts)"""


def _splits(log: str, cut: float = 0.05) -> str:
    return f"""{log},
{COUNTS},
{FOLDED},
limits AS (SELECT kind, quantile_cont(items, {cut}) AS threshold FROM activity GROUP BY kind),
splits AS (
  SELECT CASE WHEN kind = 'test' THEN 'test' WHEN fold < 5 THEN 'train' ELSE 'val' END AS split,
         user_id, item_id, n
  FROM folded JOIN limits USING (kind) WHERE size >= threshold)"""


def _truth(k: int = 100) -> str:
    return f"""gt AS (
  SELECT split, user_id, item_id, n,
         row_number() OVER (PARTITION BY split, user_id ORDER BY n DESC, item_id) AS rank
  FROM splits QUALIFY rank <= {k})"""


def _popular(k: int, source: str = "splits WHERE split = 'train'") -> str:
    return f"""popular AS (
  SELECT item_id, count(*) AS users FROM {source} GROUP BY item_id),
best AS (
  SELECT row_number() OVER (ORDER BY users DESC, item_id) AS rank, item_id,
         CAST(users AS DOUBLE) AS score
  FROM popular QUALIFY rank <= {k})"""


def _unseen(k: int) -> str:
    """The k best items of every user after taking away what the user has."""
    return f"""train AS (SELECT user_id, item_id FROM splits WHERE split = 'train'),
popular AS (SELECT item_id, count(*) AS users FROM train GROUP BY item_id),
personal AS (
  SELECT u.user_id, p.item_id,
         row_number() OVER (PARTITION BY u.user_id ORDER BY p.users DESC, p.item_id) AS rank
  FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN popular p ANTI JOIN train
    ON train.user_id = u.user_id AND train.item_id = p.item_id
  QUALIFY rank <= {k})"""


def _votes(betas: Sequence[int], k: int = 100) -> str:
    grid = ", ".join(f"({b})" for b in betas)
    return f"""train AS (SELECT * FROM splits WHERE split = 'train'),
plays AS (SELECT item_id, count(*) AS users FROM train GROUP BY item_id),
ballots AS (
  SELECT item_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS r
  FROM train
  WHERE item_id IN (SELECT item_id FROM plays
                    WHERE users >= (SELECT quantile_cont(users, 0.05) FROM plays))
  QUALIFY r <= {k}),
votes AS (SELECT item_id, sum({k + 1} - r) AS points, count(*) AS voters FROM ballots GROUP BY item_id),
grid AS (SELECT CAST(b AS BIGINT) AS beta FROM (VALUES {grid}) t(b)),
scores AS (
  SELECT beta, item_id, CAST(points AS DOUBLE) / (voters + beta) AS score FROM votes CROSS JOIN grid),
voted AS (
  SELECT beta, row_number() OVER (PARTITION BY beta ORDER BY score DESC, item_id) AS rank,
         item_id, score
  FROM scores QUALIFY rank <= {k})"""


def _metrics(lists: str, models: str, group: str, ks: Sequence[int]) -> str:
    """CTE ``metrics``: one row per group and model, every metric unrounded.

    ``lists`` is a relation (model, rank, item_id[, group][, user_id]); ``models`` one of (model).
    """
    on_group = f"AND l.{group} = g.{group}" if group == "seed" else ""
    if "user_id" in lists:
        on_group += " AND l.user_id = g.user_id"
    sums = "".join(
        f""",
         count(*) FILTER (WHERE rank <= {k}) AS hits_{k},
         coalesce(sum(CAST(h AS DOUBLE) / rank) FILTER (WHERE rank <= {k}), 0) AS ap_{k},
         coalesce(sum(1.0::DOUBLE / ln(rank + 1.0::DOUBLE)) FILTER (WHERE rank <= {k}), 0) AS dcg_{k}"""
        for k in ks
    )
    columns = "".join(
        f""",
         sum(coalesce(ap_{k} / least(m, {k}), 0)) / count(*) AS map_at_{k},
         sum(coalesce(hits_{k} / {k}.0::DOUBLE, 0)) / count(*) AS precision_at_{k},
         sum(coalesce(hits_{k} / CAST(m AS DOUBLE), 0)) / count(*) AS recall_at_{k},
         sum(coalesce(dcg_{k} / (SELECT g FROM ideal WHERE i = least(m, {k})), 0)) / count(*) AS ndcg_at_{k}"""
        for k in ks
    )
    top = max(ks, default=1)
    return f"""sizes AS (SELECT {group}, user_id, count(*) AS m FROM gt GROUP BY {group}, user_id),
ideal AS (
  SELECT i, sum(1.0::DOUBLE / ln(i + 1.0::DOUBLE)) OVER (ORDER BY i) AS g FROM range(1, {top + 1}) t(i)),
hits AS (
  SELECT g.{group}, l.model, g.user_id, l.rank,
         row_number() OVER (PARTITION BY g.{group}, l.model, g.user_id ORDER BY l.rank) AS h
  FROM gt g JOIN ({lists}) l ON l.item_id = g.item_id {on_group}),
per_user AS (
  SELECT {group}, model, user_id, sum(CAST(h AS DOUBLE) / rank) AS ap, count(*) AS hits{sums}
  FROM hits GROUP BY {group}, model, user_id),
metrics AS (
  SELECT {group}, model, count(*) AS users,
         sum(coalesce(ap / m, 0)) / count(*) AS map,
         sum(coalesce(ap / hits, 0)) / count(*) AS map_hit_norm{columns}
  FROM sizes CROSS JOIN ({models}) LEFT JOIN per_user USING ({group}, model, user_id)
  GROUP BY {group}, model)"""


def _rounded(names: Sequence[str]) -> str:
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


def _at(ks: Sequence[int]) -> list[str]:
    return [f"{m}_at_{k}" for k in ks for m in ("map", "precision", "recall", "ndcg")]


_ONE = "SELECT 0 AS model"
_BEST = "SELECT 0 AS model, rank, item_id FROM best"
_VOTED = "SELECT beta AS model, rank, item_id FROM voted"


def _popularity_metrics(log: str, ks: Sequence[int], k: int, names: Sequence[str]) -> str:
    return f"""WITH {_splits(log)},
{_truth()},
{_popular(k)},
{_metrics(_BEST, _ONE, "split", ks)}
SELECT split, users, {_rounded(names)} FROM metrics"""


def _sweep(log: str, k: int) -> str:
    return f"""WITH {_splits(log)},
{_truth(k)},
{_votes(BETAS, k)},
{_metrics(_VOTED, "SELECT beta AS model FROM grid", "split", ())}"""


def _profile(log: str) -> str:
    return f"""WITH {log},
{COUNTS}
SELECT kind, min(items) AS min_items, round(quantile_cont(items, 0.25), 9) AS q1,
       round(quantile_cont(items, 0.5), 9) AS q2, round(quantile_cont(items, 0.75), 9) AS q3,
       max(items) AS max_items, round(avg(items), 9) AS avg_items
FROM activity GROUP BY kind"""


def _seed_runs() -> str:
    seeds = ", ".join(f"({s})" for s in STABILITY_SEEDS)
    return f"""WITH {EVENTS},
{COUNTS},
seeded AS (
  SELECT CAST(s AS BIGINT) AS seed, user_id, item_id, n,
         count(*) OVER (PARTITION BY s, user_id) AS size,
         ntile(5) OVER (PARTITION BY s, user_id ORDER BY {_key("s")}, item_id) AS fold
  FROM counts CROSS JOIN (VALUES {seeds}) t(s) WHERE kind = 'train'),
folds AS (
  SELECT * FROM seeded
  WHERE size >= (SELECT quantile_cont(items, 0.05) FROM activity WHERE kind = 'train')),
gt AS (
  SELECT seed, user_id, item_id FROM folds WHERE fold = 5
  QUALIFY row_number() OVER (PARTITION BY seed, user_id ORDER BY n DESC, item_id) <= {EVENTS_LIST}),
best AS (
  SELECT seed, item_id, row_number() OVER (PARTITION BY seed ORDER BY count(*) DESC, item_id) AS rank
  FROM folds WHERE fold < 5 GROUP BY seed, item_id QUALIFY rank <= {EVENTS_LIST}),
{_metrics("SELECT 0 AS model, seed, rank, item_id FROM best", _ONE, "seed", ())}"""


def _size_sweep() -> str:
    # the first eight hex digits of the pair's hash, against the fraction of 2^32
    bounds = ", ".join(
        f"({f}, '{round(f * 2**32):08x}')" if f < 1 else f"({f}, 'g')" for f in FRACTIONS
    )
    return f"""WITH {_splits(ORDERS)},
grid AS (SELECT CAST(f AS DOUBLE) AS fraction, bound FROM (VALUES {bounds}) t(f, bound)),
sampled AS (
  SELECT fraction, user_id, item_id, n FROM splits CROSS JOIN grid
  WHERE split = 'train' AND substr({_key("'size|10'")}, 1, 8) < bound),
best AS (
  SELECT fraction, item_id,
         row_number() OVER (PARTITION BY fraction ORDER BY count(*) DESC, item_id) AS rank
  FROM sampled GROUP BY fraction, item_id QUALIFY rank <= 100),
{_truth()},
{_metrics("SELECT fraction AS model, rank, item_id FROM best", "SELECT fraction AS model FROM grid", "split", ())}
SELECT model AS fraction, (SELECT count(*) FROM sampled s WHERE s.fraction = model) AS train_rows,
       users, round(map, 9) AS map
FROM metrics WHERE split = 'val'"""


IDS = f"""{ORDERS},
{TRACKS},
parts AS (
  SELECT 'train' AS type, user_id, item_id, 1 AS part FROM log WHERE kind = 'train'
  UNION ALL
  SELECT 'train', user_id, item_id, 2 FROM log WHERE ts < TIMESTAMP '{ORDERS_SMALL_CUT}'
  UNION ALL
  SELECT 'test', user_id, item_id, 3 FROM log WHERE kind = 'test'),
all_users AS (SELECT DISTINCT part, type, user_id FROM parts),
all_tracks AS (
  SELECT DISTINCT part, type, recording_msid, recording_mbid FROM parts JOIN tracks USING (item_id)),
keyed_log AS (
  SELECT kind, ts, user_id, concat('m-', item_id) AS recording_msid FROM log)"""


def _id_maps(where: str = "true") -> str:
    return f"""u AS (
  SELECT user_id, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR))) AS u_id,
         string_agg(DISTINCT type, ',' ORDER BY type) AS types
  FROM all_users WHERE {where} GROUP BY user_id),
canon AS (
  SELECT recording_msid, coalesce(min(nullif(recording_mbid, '')), recording_msid) AS long_id,
         string_agg(DISTINCT type, ',' ORDER BY type) AS types
  FROM all_tracks WHERE {where} GROUP BY recording_msid),
items AS (
  SELECT dense_rank() OVER (ORDER BY md5(long_id)) AS track_id, recording_msid, long_id, types
  FROM canon WHERE long_id != ''),
encoded AS (
  SELECT kind, ts, track_id, u.u_id AS user_id
  FROM keyed_log LEFT JOIN items USING (recording_msid) LEFT JOIN u USING (user_id))"""


#: Links of every submission with the first of its keys, then everything within reach.
_LINKED = r"""WITH RECURSIVE submissions AS (
  SELECT concat('m-', p_partkey) AS msid,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN NULL
              WHEN p_partkey % 9 = 0 THEN 'b-hot' ELSE concat('b-', p_partkey // 4) END AS mbid,
         regexp_replace(lower(CASE WHEN p_partkey % 11 = 0 THEN concat('Песня ', p_partkey // 22)
              WHEN p_partkey % 13 = 0 THEN '!!!' ELSE p_name END), '[^\p{L}\p{N}]+', '', 'g') AS title,
         regexp_replace(lower(concat(p_brand, '/', p_partkey % 17)), '[^\p{L}\p{N}]+', '', 'g') AS artist
  FROM part),
keyed AS (
  SELECT msid, concat('m', mbid) AS key FROM submissions WHERE mbid IS NOT NULL
  UNION SELECT msid, concat('n', title, '|', artist) FROM submissions WHERE title <> '' AND artist <> ''),
star AS (SELECT msid AS x, min(msid) OVER (PARTITION BY key) AS y FROM keyed),
edge AS (SELECT x, y FROM star UNION SELECT y, x FROM star),
reach AS (
  SELECT msid AS x, msid AS y FROM submissions
  UNION SELECT r.x, e.y FROM reach r JOIN edge e ON e.x = r.y),
linked AS (SELECT x AS recording_msid, min(y) AS linked_key FROM reach GROUP BY x),
numbered AS (
  SELECT linked_key, row_number() OVER (ORDER BY md5(linked_key)) AS track_id
  FROM (SELECT DISTINCT linked_key FROM linked))
SELECT recording_msid, linked_key, track_id FROM linked JOIN numbered USING (linked_key)"""
#: Ten best products of every vector with all of them.
_ALL_PRODUCTS = """WITH pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS item_id,
         list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
  FROM embeddings a CROSS JOIN embeddings b)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, item_id) AS rank, item_id,
       round(s, 6) AS score
FROM pairs QUALIFY rank <= 10"""


def all_oracles() -> dict[str, str]:
    at_orders, at_events = (10, 100), (1, 5, 10)
    return {
        "interaction_counts": f"WITH {EVENTS}, {COUNTS} SELECT * FROM counts",
        "interaction_counts_orders": f"WITH {ORDERS}, {COUNTS} SELECT * FROM counts",
        "activity_profile_events": _profile(EVENTS),
        "activity_profile_orders": _profile(ORDERS),
        "activity_thresholds": f"""WITH {ORDERS}, {COUNTS}
SELECT kind, round(quantile_cont(items, 0.05), 9) AS threshold, 0.05::DOUBLE AS fraction
FROM activity GROUP BY kind
UNION ALL
SELECT kind, round(quantile_cont(items, 0.2), 9), 0.2::DOUBLE FROM activity GROUP BY kind""",
        "active_user_pairs": f"""WITH {ORDERS}, {COUNTS},
limits AS (SELECT kind, quantile_cont(items, 0.2) AS threshold FROM activity GROUP BY kind)
SELECT kind, user_id, items, pairs FROM activity JOIN limits USING (kind) WHERE pairs >= threshold""",
        "split_assignments": f"WITH {EVENTS}, {COUNTS}, {FOLDED} SELECT * FROM folded",
        "split_assignments_orders": f"WITH {ORDERS}, {COUNTS}, {FOLDED} SELECT * FROM folded",
        "split_sizes": f"""WITH {_splits(ORDERS)}
SELECT split, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM splits GROUP BY split""",
        "split_sizes_latent": f"""WITH {_splits(EVENTS, 0.2)}
SELECT split, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM splits GROUP BY split""",
        "users_without_validation": f"""WITH {ORDERS}, {COUNTS}, {FOLDED}
SELECT user_id, count(*) AS size FROM folded WHERE kind = 'train'
GROUP BY user_id HAVING max(fold) < 5""",
        "ground_truth_long": f"WITH {_splits(EVENTS)}, {_truth()} SELECT split, user_id, rank, item_id, n FROM gt",
        "ground_truth_lists": f"""WITH {_splits(EVENTS)}, {_truth()}
SELECT split, user_id, string_agg(item_id, ',' ORDER BY rank) FILTER (WHERE rank <= 5) AS gt,
       count(*) AS n_items
FROM gt GROUP BY split, user_id""",
        "ground_truth_flattened": f"""WITH {_splits(ORDERS)}, {_truth()}
SELECT split, user_id, rank, CAST(item_id AS DOUBLE) AS item FROM gt""",
        "popularity_top100": f"WITH {_splits(ORDERS)}, {_popular(100)} SELECT rank, item_id, score FROM best",
        "popularity_report": f"""WITH {ORDERS}, {TRACKS},
counts AS (SELECT user_id, item_id FROM log GROUP BY user_id, item_id),
{_popular(100, "counts")}
SELECT rank, item_id, score, track_name, artist_name FROM best JOIN tracks USING (item_id)""",
        "popularity_as_arrays": f"""WITH {_splits(EVENTS)}, {_popular(100)}
SELECT 'popularity' AS model, string_agg(item_id, ',' ORDER BY rank) AS pred,
       string_agg(CAST(score AS BIGINT), ',' ORDER BY rank) AS scores
FROM best""",
        "active_item_counts": f"""WITH {_splits(ORDERS)}, {_popular(1)}
SELECT item_id, users FROM popular WHERE users >= (SELECT quantile_cont(users, 0.05) FROM popular)""",
        "damped_vote_top100": f"""WITH {_splits(ORDERS)}, {_votes([50])}
SELECT beta, rank, item_id, round(score, 9) AS score FROM voted""",
        "damped_vote_grid": f"""WITH {_splits(EVENTS)}, {_votes(BETAS)}
SELECT beta, rank, item_id, round(score, 9) AS score FROM voted""",
        "map_popularity": _popularity_metrics(ORDERS, (), 100, ["map"]),
        "map_hit_norm": _popularity_metrics(EVENTS, (), EVENTS_LIST, ["map", "map_hit_norm"]),
        "map_popularity_unseen": f"""WITH {_splits(ORDERS)},
{_truth()},
{_unseen(20)},
{_metrics("SELECT 0 AS model, user_id, rank, item_id FROM personal", _ONE, "split", (10,))}
SELECT split, users, {_rounded(["map", "map_hit_norm", *_at((10,))])} FROM metrics""",
        "map_popularity_unseen_100": f"""WITH {_splits(ORDERS)},
{_truth()},
{_unseen(100)},
{_metrics("SELECT 0 AS model, user_id, rank, item_id FROM personal", _ONE, "split", (10,))}
SELECT split, users, {_rounded(["map", "map_hit_norm", *_at((10,))])} FROM metrics""",
        "unseen_list_sizes": f"""WITH {_splits(ORDERS)},
{_unseen(20)}
SELECT user_id, count(*) AS items, CAST(sum(item_id) AS BIGINT) AS total FROM personal GROUP BY user_id""",
        "als_list_faults": f"""WITH {_splits(ORDERS)},
train AS (SELECT DISTINCT user_id, item_id FROM splits WHERE split = 'train')
SELECT count(DISTINCT user_id) AS users,
       count(DISTINCT user_id) * least(100, count(DISTINCT item_id)) AS rows,
       CAST(0 AS BIGINT) AS repeats, CAST(0 AS BIGINT) AS order_faults, CAST(0 AS BIGINT) AS score_faults
FROM train""",
        "als_pruned_search": f"""WITH {_splits(ORDERS)},
train AS (SELECT DISTINCT user_id, item_id FROM splits WHERE split = 'train'),
size AS (SELECT count(DISTINCT user_id) AS users, greatest(1, count(DISTINCT item_id) // 200) AS k FROM train)
SELECT f.factors, users, users * k AS rows, CAST(0 AS BIGINT) AS different_rows,
       true AS half_saved, true AS half_skipped
FROM size CROSS JOIN (VALUES (CAST(1 AS BIGINT)), (4)) AS f(factors)""",
        "als_forest_faults": f"""WITH {_splits(ORDERS)},
size AS (SELECT count(DISTINCT user_id) AS users FROM splits WHERE split = 'train')
SELECT t.trees, users, CAST(0 AS BIGINT) AS repeats, CAST(0 AS BIGINT) AS order_faults,
       CAST(0 AS BIGINT) AS score_faults, true AS recall_90, true AS half_saved
FROM size CROSS JOIN (VALUES (CAST(4 AS BIGINT)), (10)) AS t(trees)""",
        "als_fit_faults": f"""WITH {_splits(ORDERS)}
SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS off FROM splits WHERE split = 'train'""",
        "als_unseen": f"""WITH {_splits(ORDERS)},
train AS (SELECT DISTINCT user_id, item_id FROM splits WHERE split = 'train'),
sizes AS (
  SELECT user_id, least(20, (SELECT count(DISTINCT item_id) FROM train) - count(*)) AS items
  FROM train GROUP BY user_id)
SELECT user_id, items, CAST(0 AS BIGINT) AS seen_items, items AS last_rank, items AS different
FROM sizes WHERE items > 0""",
        "als_unseen_100": f"""WITH {_splits(ORDERS)},
train AS (SELECT DISTINCT user_id, item_id FROM splits WHERE split = 'train'),
sizes AS (
  SELECT user_id, least(100, (SELECT count(DISTINCT item_id) FROM train) - count(*)) AS items
  FROM train GROUP BY user_id)
SELECT user_id, items, CAST(0 AS BIGINT) AS seen_items, items AS last_rank, items AS different,
       CAST(0 AS BIGINT) AS better_left_out
FROM sizes WHERE items > 0""",
        "ranking_metrics_at_k": _popularity_metrics(
            ORDERS, at_orders, 100, ["map", "map_hit_norm", *_at(at_orders)]
        ),
        "ranking_metrics_at_k_events": _popularity_metrics(
            EVENTS, at_events, EVENTS_LIST, ["map", "map_hit_norm", *_at(at_events)]
        ),
        "beta_sweep_orders": f"""{_sweep(ORDERS, 100)}
SELECT split, model AS beta, users, round(map, 9) AS map FROM metrics""",
        "beta_sweep_events": f"""{_sweep(EVENTS, EVENTS_LIST)}
SELECT split, model AS beta, users, round(map, 9) AS map FROM metrics""",
        "beta_best": f"""{_sweep(EVENTS, EVENTS_LIST)},
wide AS (
  SELECT model AS beta, max(map) FILTER (WHERE split = 'train') AS train_map,
         max(map) FILTER (WHERE split = 'val') AS val_map,
         max(map) FILTER (WHERE split = 'test') AS test_map
  FROM metrics GROUP BY model)
SELECT beta, {_rounded(["train_map", "val_map", "test_map"])},
       beta = (SELECT min(beta) FROM wide) OR beta = (SELECT max(beta) FROM wide) AS best_at_edge
FROM wide ORDER BY wide.val_map DESC, beta LIMIT 1""",
        "split_seed_runs": f"{_seed_runs()}\nSELECT seed, users, round(map, 9) AS map FROM metrics",
        "split_stability": f"""{_seed_runs()}
SELECT count(map) AS runs, round(avg(map), 9) AS mean_map, round(stddev_samp(map), 9) AS stddev_map
FROM metrics""",
        "size_sweep_popularity": _size_sweep(),
        "user_ids": f"WITH {IDS}, {_id_maps()} SELECT user_id, u_id, types FROM u",
        "item_ids": f"WITH {IDS}, {_id_maps()} SELECT track_id, recording_msid, types FROM items",
        "encoded_interactions": f"WITH {IDS}, {_id_maps()} SELECT * FROM encoded",
        "encoded_interaction_counts": f"""WITH {IDS}, {_id_maps()}
SELECT kind, user_id, track_id AS item_id, count(*) AS n FROM encoded GROUP BY kind, user_id, track_id""",
        "unmatched_interactions": f"""WITH {IDS}, {_id_maps("type = 'test'")}
SELECT count(*) FILTER (WHERE track_id IS NULL) AS no_item,
       count(*) FILTER (WHERE user_id IS NULL) AS no_user
FROM encoded""",
        "id_source_shapes": f"""WITH {IDS}
SELECT type, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_columns, 'users' AS source
FROM all_users GROUP BY type
UNION ALL
SELECT type, count(*), CAST(2 AS BIGINT), 'tracks' FROM all_tracks GROUP BY type""",
        "item_groups": f"""WITH {IDS}, {_id_maps()},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY long_id ORDER BY md5(recording_msid)) AS pos FROM items)
SELECT long_id, CAST((pos - 1) // 1000 AS BIGINT) AS chunk,
       string_agg(recording_msid, ',' ORDER BY pos) AS msids, string_agg(types, ';' ORDER BY pos) AS types
FROM numbered GROUP BY ALL""",
        "ungrouped_items": f"WITH {IDS}, {_id_maps()} SELECT long_id, recording_msid, types FROM items",
        "normalised_item_keys": f"""WITH {TRACKS}
SELECT recording_msid,
       concat(regexp_replace(lower(track_name), '[^a-z0-9]+', '', 'g'),
              regexp_replace(lower(artist_name), '[^a-z0-9]+', '', 'g')) AS concat_id
FROM tracks""",
        "linked_item_ids": _LINKED,
        "artifact_round_trip": f"""WITH {ORDERS}, {COUNTS}
SELECT kind, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS events FROM counts GROUP BY kind""",
        "partitioned_truth": f"""WITH {_splits(EVENTS)}, {_truth()}
SELECT user_id, rank, item_id, n, split FROM gt WHERE split = 'val'""",
        "stored_vote_runs": f"""WITH {_splits(ORDERS)}, {_votes(BETAS)}
SELECT rank, item_id, round(score, 9) AS score, beta FROM voted WHERE beta IN (10, 100)""",
        "csv_round_trip": f"""WITH {ORDERS},
counts AS (SELECT user_id, item_id, count(*) AS n FROM log GROUP BY user_id, item_id)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS rank, item_id,
       CAST(n AS DOUBLE) AS score
FROM counts QUALIFY rank <= 100""",
        "exact_topk_search": _ALL_PRODUCTS,
        "pruned_topk_search": _ALL_PRODUCTS,
    }
