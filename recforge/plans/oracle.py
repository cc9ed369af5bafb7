"""Independent SQL for every exactly-checked query (run by DuckDB).

Each string reads only the driver's pre-registered tables; the rating,
product and vector views are derived here with the same arithmetic as
``recforge.sources.fixtures``.  Window orders are total (tie-breakers), and
floats are rounded to 6 places wherever the Spark query rounds them.
"""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT o_custkey AS userId, l_partkey AS productId,
         CAST(ceil(l_quantity / 5) AS DOUBLE) / CAST(2 AS DOUBLE) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts,
         l_orderkey, l_linenumber, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS productId,
         p_name || ' (' || CAST(1970 + p_size AS VARCHAR) || ')' AS title,
         p_type || '|' || replace(p_name, ' ', '|') AS types
  FROM part)"""

ORDER = "ts, productId, l_orderkey, l_linenumber, l_extendedprice"


def fmt2(expr: str) -> str:
    return f"format('{{:,.2f}}', {expr})"


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


YEAR = """CASE WHEN trim(title) IS NULL OR length(trim(title)) < 6 THEN 1990
            ELSE coalesce(TRY_CAST(substring(trim(title), length(trim(title)) - 4, 4) AS INTEGER), 1990) END"""

# Ratings with label, product join, release year, types and product stats.
SAMPLE_BASE = [
    RATINGS,
    PRODUCTS,
    """wp AS (
  SELECT r.*, CASE WHEN r.rating >= 3.5 THEN 1 ELSE 0 END AS label,
         """ + YEAR + """ AS releaseYear,
         p.types,
         string_split(p.types, '|')[1] AS productType1,
         string_split(p.types, '|')[2] AS productType2,
         string_split(p.types, '|')[3] AS productType3
  FROM ratings r LEFT JOIN products p USING (productId))""",
    """ps AS (
  SELECT productId, count(*) AS productRatingCount,
         """ + fmt2("avg(rating)") + """ AS productAvgRating,
         """ + fmt2("coalesce(stddev_samp(rating), 0)") + """ AS productRatingStddev
  FROM wp GROUP BY productId)""",
]


def sample_windows(history: int = 100) -> str:
    return f"""win AS (
  SELECT wp.*, ps.productRatingCount, ps.productAvgRating, ps.productRatingStddev,
    list_reverse(list_filter(list(CASE WHEN label = 1 THEN wp.productId END) OVER w, lambda x: x IS NOT NULL)) AS hist,
    count(*) OVER w AS userRatingCount,
    CAST(trunc(avg(releaseYear) OVER w) AS INTEGER) AS userAvgReleaseYear,
    {fmt2('stddev_samp(releaseYear) OVER w')} AS userReleaseYearStddev,
    {fmt2('avg(rating) OVER w')} AS userAvgRating,
    {fmt2('stddev_samp(rating) OVER w')} AS userRatingStddev,
    list_filter(list(CASE WHEN label = 1 THEN types END) OVER w, lambda x: x IS NOT NULL) AS tl
  FROM wp LEFT JOIN ps USING (productId)
  WINDOW w AS (PARTITION BY userId ORDER BY {ORDER} ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)),
words AS (
  SELECT * EXCLUDE (tl), flatten(list_transform(tl, lambda t: string_split(t, '|'))) AS wl
  FROM win WHERE userRatingCount > 1),
ranked AS (
  SELECT * EXCLUDE (wl),
    list_transform(list_sort(list_transform(list_filter(wl, lambda x, i: list_position(wl, x) = i),
        lambda x, i: {{'n': -len(list_filter(wl, lambda y: y = x)), 'pos': i, 'w': x}})), lambda s: s.w) AS ut
  FROM words)"""


SAMPLE_SELECT = """SELECT userId, productId, rating, ts AS "timestamp", label, releaseYear,
  productType1, productType2, productType3,
  productRatingCount, productAvgRating, productRatingStddev,
  hist[1] AS userRatedproduct1, hist[2] AS userRatedproduct2, hist[3] AS userRatedproduct3,
  hist[4] AS userRatedproduct4, hist[5] AS userRatedproduct5,
  userRatingCount, userAvgReleaseYear, userReleaseYearStddev, userAvgRating, userRatingStddev,
  ut[1] AS userType1, ut[2] AS userType2, ut[3] AS userType3, ut[4] AS userType4, ut[5] AS userType5
FROM ranked"""


def training_samples_sql() -> str:
    return with_views(*SAMPLE_BASE, sample_windows()) + SAMPLE_SELECT


def minimum_slice_sql() -> str:
    return (
        with_views(*SAMPLE_BASE, sample_windows())
        + """SELECT userId, productId, ts AS "timestamp", label, releaseYear, userRatingCount,
  userAvgReleaseYear, userAvgRating, userRatingStddev FROM ranked"""
    )


# ---------------------------------------------------------------- basics
def basic_sql() -> dict[str, str]:
    r = with_views(RATINGS)
    rp = with_views(RATINGS, PRODUCTS)
    return {
        "add_label": r + "SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label FROM ratings",
        "positive_only": r + "SELECT * FROM ratings WHERE rating >= 3.5",
        "rating_histogram": r + """SELECT rating, count(*) AS "count",
            CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percentage
            FROM ratings GROUP BY rating""",
        "rating_count": r + "SELECT count(*) AS n FROM ratings",
        "product_attributes": with_views(PRODUCTS) + f"""SELECT productId, {YEAR} AS releaseYear,
            trim(substring(trim(title), 1, greatest(length(trim(title)) - 6, 0))) AS cleanTitle,
            string_split(types, '|')[1] AS productType1,
            string_split(types, '|')[2] AS productType2,
            string_split(types, '|')[3] AS productType3
            FROM products""",
        "product_types": with_views(PRODUCTS) + "SELECT productId, unnest(string_split(types, '|')) AS type FROM products",
        "ratings_with_products": rp + f"""SELECT r.*, {YEAR} AS releaseYear, p.types,
            string_split(p.types, '|')[1] AS productType1,
            string_split(p.types, '|')[2] AS productType2,
            string_split(p.types, '|')[3] AS productType3
            FROM ratings r LEFT JOIN products p USING (productId)""",
        "product_rating_features": r + f"""SELECT productId, count(*) AS productRatingCount,
            {fmt2('avg(rating)')} AS productAvgRating,
            {fmt2('coalesce(stddev_samp(rating), 0)')} AS productRatingStddev
            FROM ratings GROUP BY productId""",
        "product_stats": r + """SELECT productId, count(*) AS ratingCount, round(avg(rating), 6) AS avgRating,
            round(var_samp(rating), 6) AS ratingVar FROM ratings GROUP BY productId""",
        "distinct_users": r + "SELECT DISTINCT userId FROM ratings ORDER BY userId LIMIT 3",
        "typed_ratings": r + """SELECT *, CAST(userId AS INTEGER) AS userIdInt, CAST(productId AS INTEGER) AS productIdInt,
            CAST(rating AS FLOAT) AS ratingFloat FROM ratings""",
        "user_timeline": r + """SELECT * FROM ratings WHERE userId = (SELECT min(userId) FROM ratings)""",
    }


# ---------------------------------------------------------------- sequences
POSITIVE_SEQ = """pos AS (
  SELECT userId, productId,
         row_number() OVER (PARTITION BY userId ORDER BY """ + ORDER + """) - 1 AS p,
         lead(productId) OVER (PARTITION BY userId ORDER BY """ + ORDER + """) AS nxt
  FROM ratings WHERE rating >= 3.5)"""

PAIRS = """pairs AS (SELECT productId AS src, nxt AS dst, count(*) AS cnt FROM pos WHERE nxt IS NOT NULL GROUP BY ALL)"""


def sequence_sql() -> dict[str, str]:
    base = with_views(RATINGS, POSITIVE_SEQ, PAIRS)
    return {
        "item_sequences": base + """SELECT userId, CAST(floor(p / 1000) AS BIGINT) AS sentence,
            string_agg(CAST(productId AS VARCHAR), ' ' ORDER BY p) AS productIdStr
            FROM pos GROUP BY userId, floor(p / 1000)""",
        "item_sequences_short": base + """SELECT userId, CAST(floor(p / 4) AS BIGINT) AS sentence,
            string_agg(CAST(productId AS VARCHAR), ' ' ORDER BY p) AS productIdStr
            FROM pos GROUP BY userId, floor(p / 4)""",
        "pair_counts": base + "SELECT src, dst, cnt FROM pairs",
        "transition_probs": base + """SELECT src, dst, cnt,
            CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY src) AS DOUBLE) AS prob FROM pairs""",
        "item_distribution": base + """SELECT src AS item, CAST(sum(cnt) AS BIGINT) AS cnt,
            CAST(sum(cnt) AS DOUBLE) / CAST((SELECT sum(cnt) FROM pairs) AS DOUBLE) AS prob
            FROM pairs GROUP BY src""",
    }


# ---------------------------------------------------------------- embeddings
def _sqdist(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) * (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE))))")


def _dot(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)))")


USER_EMB = """pc AS (SELECT userId, productId, count(*) AS n FROM ratings GROUP BY ALL),
ux AS (SELECT pc.userId, pc.n, e.embedding FROM pc JOIN embeddings e ON e.vec_id = pc.productId),
ud AS (SELECT userId, n, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS v FROM ux),
ue AS (SELECT userId, dim, sum(CAST(v AS DOUBLE) * n) AS value FROM ud GROUP BY userId, dim),
uemb AS (SELECT userId, list(value ORDER BY dim) AS emb FROM ue GROUP BY userId)"""


def _near(item: str, table: str, key: str, place: str) -> str:
    """Pairs of items at most five places apart in a sequence, in both directions."""
    return f"""win AS (SELECT x.{item} AS a, y.{item} AS b FROM {table} x JOIN {table} y ON x.{key} = y.{key} AND y.{place} - x.{place} BETWEEN 1 AND 5),
near AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM win UNION ALL SELECT b, a FROM win) GROUP BY a, b)"""


NEAR = _near("productId", "pos", "userId", "p")

ASSOCIATIONS = """own AS (SELECT a, sum(n) AS na FROM near GROUP BY a),
associated AS (SELECT * FROM (
  SELECT n.a, n.b, ln(n.n * (SELECT CAST(sum(n) AS DOUBLE) FROM near) / (CAST(x.na AS DOUBLE) * CAST(y.na AS DOUBLE))) AS w
  FROM near n JOIN own x ON x.a = n.a JOIN own y ON y.a = n.b) WHERE w > 0)"""


def embedding_sql() -> dict[str, str]:
    return {
        "ratings_with_vectors": with_views(RATINGS) + """SELECT r.*, CAST(len(e.embedding) AS INTEGER) AS dims,
            round(sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
            FROM ratings r JOIN embeddings e ON e.vec_id = r.productId""",
        "user_embeddings": with_views(RATINGS, USER_EMB) + "SELECT userId, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM ue",
        "nearest_k": f"""WITH q AS (SELECT embedding AS qv FROM embeddings WHERE vec_id = 0),
            d AS (SELECT vec_id, sqrt({_sqdist('embedding', 'qv')}) AS dist FROM embeddings, q)
            SELECT vec_id, round(dist, 6) AS distance FROM d ORDER BY dist, vec_id LIMIT 5""",
        "most_similar": f"""WITH q AS (SELECT embedding AS qv FROM embeddings WHERE vec_id = 0),
            s AS (SELECT vec_id, {_dot('embedding', 'qv')} / (sqrt({_dot('embedding', 'embedding')}) * sqrt({_dot('qv', 'qv')})) AS sim
            FROM embeddings, q WHERE vec_id <> 0)
            SELECT vec_id, round(sim, 6) AS similarity FROM s ORDER BY sim DESC, vec_id LIMIT 20""",
        "two_tower_scores": with_views(RATINGS, USER_EMB) + f""", sc AS (
            SELECT p.userId, p.productId, {_dot('u.emb', 'e.embedding')} AS score
            FROM (SELECT DISTINCT userId, productId FROM ratings) p
            JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId),
            rk AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS rank FROM sc)
            SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""",
        "two_tower_new_items": with_views(RATINGS, POSITIVE_SEQ, PAIRS, USER_EMB) + f""",
            rated AS (SELECT DISTINCT userId, productId FROM ratings),
            cand AS (SELECT DISTINCT userId, dst AS productId FROM rated JOIN pairs ON src = productId
                     EXCEPT SELECT userId, productId FROM rated),
            sc AS (SELECT p.userId, p.productId, {_dot('u.emb', 'e.embedding')} AS score
            FROM cand p JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId),
            rk AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS rank FROM sc)
            SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""",
        "catalogue_top_items": with_views(RATINGS, USER_EMB) + f""", sc AS (
            SELECT u.userId, e.vec_id AS productId, {_dot('u.emb', 'e.embedding')} AS score FROM uemb u, embeddings e
            WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userId = u.userId AND r.productId = e.vec_id)),
            rk AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS rank FROM sc)
            SELECT userId, productId, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""",
        "exact_neighbours": f"""WITH unit AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt({_dot('embedding', 'embedding')})) AS v FROM embeddings),
            s AS (SELECT a.vec_id AS query, b.vec_id AS id, {_dot('a.v', 'b.v')} AS score FROM unit a JOIN unit b ON a.vec_id <> b.vec_id),
            rk AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM s)
            SELECT query, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 20""",
        "window_counts": with_views(RATINGS, POSITIVE_SEQ, NEAR) + "SELECT a, b, n FROM near",
        "associations": with_views(RATINGS, POSITIVE_SEQ, NEAR, ASSOCIATIONS) + "SELECT a, b, round(w, 6) AS w FROM associated",
        "fm_interaction": with_views(RATINGS, USER_EMB) + f""", f AS (
            SELECT p.userId, p.productId, u.emb AS a, e.embedding AS b
            FROM (SELECT DISTINCT userId, productId FROM ratings) p
            JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId)
            SELECT userId, productId, round(list_sum(list_transform(range(1, len(a) + 1),
              lambda i: (CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE)) * (CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE))
                        - (CAST(a[i] AS DOUBLE) * CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE) * CAST(b[i] AS DOUBLE)))), 4) AS fm
            FROM f""",
        "fm_dimensions": with_views(RATINGS, USER_EMB) + """, f AS (
            SELECT p.userId, p.productId, u.emb AS a, e.embedding AS b, (SELECT embedding FROM embeddings WHERE vec_id = 0) AS z
            FROM (SELECT DISTINCT userId, productId FROM ratings) p
            JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId)
            SELECT userId, productId, array_to_string(list_transform(range(1, len(a) + 1), lambda i: CAST(CAST(round(1000 * (
              (CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE) + CAST(z[i] AS DOUBLE)) * (CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE) + CAST(z[i] AS DOUBLE))
              - (CAST(a[i] AS DOUBLE) * CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE) * CAST(b[i] AS DOUBLE) + CAST(z[i] AS DOUBLE) * CAST(z[i] AS DOUBLE)))) AS BIGINT) AS VARCHAR)), ',') AS terms
            FROM f""",
        "four_dots": with_views(RATINGS, USER_EMB) + f""", f AS (
            SELECT p.userId, p.productId, u.emb AS a, e.embedding AS b, (SELECT embedding FROM embeddings WHERE vec_id = 0) AS z
            FROM (SELECT DISTINCT userId, productId FROM ratings) p
            JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId)
            SELECT userId, productId, round({_dot('b', 'a')}, 4) AS item_user, round({_dot('b', 'z')}, 4) AS item_base,
              round({_dot('a', 'z')}, 4) AS user_base, round({_dot('b', 'b')}, 4) AS item_item FROM f""",
        "pair_dots": with_views(RATINGS, USER_EMB) + f""", f AS (
            SELECT p.userId, p.productId, u.emb AS a, e.embedding AS b
            FROM (SELECT DISTINCT userId, productId FROM ratings) p
            JOIN uemb u USING (userId) JOIN embeddings e ON e.vec_id = p.productId)
            SELECT userId, productId, round({_dot('b', 'a')}, 4) AS item_user, round({_dot('b', 'b')}, 6) AS item_item FROM f""",
    }


# ---------------------------------------------------------------- draws (same integers as Spark)
def pmod(a: str, m: str) -> str:
    return f"((({a}) % ({m})) + ({m})) % ({m})"


def draw(seed: int, *keys: str) -> str:
    text = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '~')" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', {text})), 1, 15) AS BIGINT)"


def below(seed: int, fraction: float, *keys: str) -> str:
    return f"{draw(seed, *keys)} < {int(round(fraction * 2 ** 60))}"


# ---------------------------------------------------------------- encoders
TYPES = """tx AS (SELECT productId, unnest(string_split(types, '|')) AS type FROM products),
tc AS (SELECT type, count(*) AS n FROM tx GROUP BY type),
ti AS (SELECT type, CAST(row_number() OVER (ORDER BY n DESC, type) - 1 AS INTEGER) AS typeIndex FROM tc)"""

# The type vocabulary, in its order.
VOCAB = ["PropertyInsurance", "LifeInsurance", "MedicalInsurance", "AccidentInsurance", "ShortTermBonds",
         "LediumTermBonds", "LongTermBonds", "StockFunds", "BondFunds", "MoneyMarketFunds", "MixedFunds",
         "Gold", "Silver", "Platinum", "Palladium", "LDW", "LDZW", "ZDLW"]


def encoder_sql() -> dict[str, str]:
    p = with_views(PRODUCTS)
    pt = with_views(PRODUCTS, TYPES)
    vocab = "[" + ", ".join(f"'{v}'" for v in VOCAB) + "]"
    return {
        "one_hot": p + """SELECT productId, CAST((SELECT max(productId) FROM products) + 1 AS INTEGER) AS size,
            CAST(productId AS INTEGER) AS idx FROM products""",
        "type_index": pt + "SELECT type, typeIndex FROM ti",
        "type_index_lists": pt + """SELECT productId, string_agg(CAST(typeIndex AS VARCHAR), ',' ORDER BY typeIndex) AS typeIndexes
            FROM tx JOIN ti USING (type) GROUP BY productId""",
        "vocabulary_size": pt + "SELECT CAST(max(typeIndex) + 1 AS INTEGER) AS indexSize FROM ti",
        "multi_hot": pt + """SELECT productId, CAST((SELECT count(*) FROM ti) AS INTEGER) AS size,
            string_agg(CAST(typeIndex AS VARCHAR), ',' ORDER BY typeIndex) AS indices
            FROM (SELECT DISTINCT productId, typeIndex FROM tx JOIN ti USING (type)) GROUP BY productId""",
        "minmax_avg_rating": with_views(RATINGS) + """, s AS (SELECT productId, avg(rating) AS avgRating FROM ratings GROUP BY productId),
            b AS (SELECT min(avgRating) AS lo, max(avgRating) AS hi FROM s)
            SELECT productId, round(avgRating, 6) AS avgRating,
              round(CASE WHEN hi = lo THEN 0.5 ELSE (avgRating - lo) / (hi - lo) END, 6) AS scaledAvgRating
            FROM s, b""",
        "identity_index": with_views(RATINGS) + """SELECT *,
            CASE WHEN productId >= 0 AND productId < 1001 THEN productId END AS productIdx,
            CASE WHEN userId >= 0 AND userId < 30001 THEN userId END AS userIdx FROM ratings""",
        "vocab_index": pt + f"""SELECT productId, type,
            CAST(coalesce(list_position({vocab}, type) - 1, -1) AS INTEGER) AS vocabIndex FROM tx""",
        "vocab_index_hits": pt + """SELECT productId, type, CAST(coalesce(list_position(
            ['ECONOMY', 'PROMO', 'STANDARD', 'blue', 'gear', 'red'], type) - 1, -1) AS INTEGER) AS vocabIndex FROM tx""",
        "id_offenders": with_views(RATINGS) + """SELECT count(*) AS rows,
            count(*) FILTER (productId < 0 OR productId >= 100) AS offenders FROM ratings""",
        "indicator": pt + """SELECT productId, type, typeIndex,
            CAST(CASE WHEN typeIndex >= 0 AND typeIndex < 10 THEN typeIndex ELSE -1 END AS INTEGER) AS hot
            FROM tx JOIN ti USING (type)""",
        "crossed": with_views(*SAMPLE_BASE, sample_windows()) + f"""SELECT userId, productId, ts AS "timestamp",
            hist[1] AS userRatedproduct1,
            CAST({pmod(draw(0, 'coalesce(productId, 0)', 'coalesce(hist[1], 0)'), '10000')} AS INTEGER) AS cross
            FROM ranked""",
    }


# ---------------------------------------------------------------- splits
def split_sql() -> dict[str, str]:
    base = with_views(*SAMPLE_BASE, sample_windows()) + """, s AS (
        SELECT userId, productId, ts AS "timestamp", label,
               hist[2] AS userRatedproduct2, hist[3] AS userRatedproduct3,
               hist[4] AS userRatedproduct4, hist[5] AS userRatedproduct5 FROM ranked)
        """
    key = ("userId", "productId", '"timestamp"')
    keep, part = below(0, 0.1, *key), below(1, 0.8, *key)
    negs = []
    for slot in (2, 3, 4, 5):
        own = f"coalesce(CAST(userRatedproduct{slot} AS BIGINT), 0)"
        h = draw(2020, *key, str(slot))
        r = pmod(h, "1000")
        negs.append(f"""CASE WHEN {own} >= 0 AND {own} < 1001
              THEN {r} + CASE WHEN {r} >= {own} THEN 1 ELSE 0 END
              ELSE {pmod(h, '1001')} END AS negtive_userRatedproduct{slot}""")
    return {
        "split_samples": base + f"""SELECT userId, productId, "timestamp", label,
            CASE WHEN {part} THEN 'train' ELSE 'test' END AS split
            FROM s WHERE {keep}""",
        "sample_job": with_views(*SAMPLE_BASE, sample_windows()) + """, s AS (
            SELECT userId, productId, ts AS "timestamp", label, productRatingCount, productAvgRating, userRatingStddev FROM ranked)
            SELECT userId, productId, "timestamp", CAST(label AS INTEGER) AS label, CASE WHEN """ + part + """ THEN 'train' ELSE 'test' END AS split,
            CAST(productRatingCount AS INTEGER) AS productRatingCount,
            round(CAST(replace(productAvgRating, ',', '') AS DOUBLE), 6) AS productAvgRating,
            round(coalesce(CAST(replace(userRatingStddev, ',', '') AS DOUBLE), 0), 6) AS userRatingStddev
            FROM s WHERE """ + keep,
        "time_split": base + """SELECT userId, productId, "timestamp", label,
            CASE WHEN "timestamp" <= (SELECT percentile_disc(0.8) WITHIN GROUP (ORDER BY "timestamp") FROM s)
                 THEN 'train' ELSE 'test' END AS split FROM s""",
        "negative_items": base + "SELECT userId, productId, \"timestamp\", userRatedproduct2, userRatedproduct3, "
            "userRatedproduct4, userRatedproduct5, " + ", ".join(negs) + " FROM s",
    }


# ---------------------------------------------------------------- walks
def walk_sql(n_walks: int = 20000, length: int = 10, seed: int = 0) -> str:
    h0, hk = draw(seed, "w", "0"), draw(seed, "walk.w", "walk.step + 1")
    return "WITH RECURSIVE " + ",\n".join([RATINGS, POSITIVE_SEQ, PAIRS]) + f""",
edges AS (SELECT src, dst, cnt,
    CAST(sum(cnt) OVER (PARTITION BY src ORDER BY dst ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS hi,
    CAST(sum(cnt) OVER (PARTITION BY src) AS BIGINT) AS tot FROM pairs),
srcs AS (SELECT src, CAST(sum(cnt) AS BIGINT) AS c FROM pairs GROUP BY src),
starts AS (SELECT src, c, CAST(sum(c) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS hi FROM srcs),
g AS (SELECT CAST(sum(c) AS BIGINT) AS total FROM srcs),
w0 AS (SELECT w, {pmod(h0, '(SELECT total FROM g)')} AS u FROM (SELECT range AS w FROM range(0, {n_walks}))),
walk(w, step, item) AS (
  SELECT w0.w, 0, s.src FROM w0 JOIN starts s ON w0.u >= s.hi - s.c AND w0.u < s.hi
  UNION ALL
  SELECT walk.w, walk.step + 1, e.dst FROM walk JOIN edges e ON e.src = walk.item
    AND {pmod(hk, 'e.tot')} >= e.hi - e.cnt AND {pmod(hk, 'e.tot')} < e.hi
  WHERE walk.step + 1 < {length})
SELECT w AS walk_id, string_agg(CAST(item AS VARCHAR), ' ' ORDER BY step) AS path, CAST(count(*) AS INTEGER) AS length
FROM walk GROUP BY w"""


# ---------------------------------------------------------------- facts about models
def _facts(**values: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{k}' AS fact, CAST(({v}) AS BIGINT) AS value" for k, v in values.items())


def fact_sql() -> dict[str, str]:
    part = below(7, 0.8, "userId", "productId", "ts", "l_orderkey", "l_linenumber")
    split = with_views(RATINGS, f"s AS (SELECT *, {part} AS train FROM ratings)", "t AS (SELECT * FROM s WHERE train)")
    seq = with_views(RATINGS, POSITIVE_SEQ, "vocab AS (SELECT productId FROM pos GROUP BY productId HAVING count(*) >= 5)")
    sample = with_views(*SAMPLE_BASE, sample_windows()) + ", x AS (SELECT userId, productId, ts AS \"timestamp\" FROM ranked) "
    test = f"SELECT count(*) FROM x WHERE NOT ({below(1, 0.8, 'userId', 'productId', '"timestamp"')})"
    walks = walk_sql().rsplit("SELECT w AS walk_id", 1)[0]
    stats = with_views(RATINGS, "p AS (SELECT productId, round(avg(rating), 9) AS m FROM ratings GROUP BY productId)")

    def als(key: str, other: str) -> str:
        k = f"SELECT count(DISTINCT {key}) FROM t"
        each = f"SELECT least(10, count(DISTINCT {other})) FROM t"
        return split + _facts(keys=k, rows_out=f"({k}) * ({each})", rank_gaps="0", rating_rises="0", subset_not_best="0",
                              subset_keys=f"SELECT least(3, count(DISTINCT {key})) FROM t", unknown_ids="0")

    ctr = {}
    for m in ("fm", "mlp", "linear", "trees", "leaves"):
        ctr |= {f"{m}_scored": test, f"{m}_is_degenerate": "0", f"{m}_no_probability": "0", f"{m}_is_constant": "0"}
    return {
        "als_user_facts": als("userId", "productId"),
        "als_item_facts": als("productId", "userId"),
        "als_catalogue_facts": split + _facts(
            user_keys="SELECT count(DISTINCT userId) FROM t", item_keys="SELECT count(DISTINCT productId) FROM t",
            user_rows="SELECT count(DISTINCT userId) * least(10, count(DISTINCT productId)) FROM t",
            item_rows="SELECT count(DISTINCT productId) * least(10, count(DISTINCT userId)) FROM t", user_not_the_best="0", item_not_the_best="0"),
        "als_rmse_facts": split + _facts(
            scored="SELECT count(*) FROM s WHERE NOT train AND userId IN (SELECT userId FROM t) AND productId IN (SELECT productId FROM t)",
            not_the_dot_product="0"),
        "als_cv_facts": "SELECT * FROM (" + _facts(grid_points="1", folds="10", rmse_out_of_range="0") + ")",
        "item2vec_facts": seq + _facts(vectors="SELECT count(*) FROM vocab", wrong_sizes="0", not_finite="0"),
        "graph_embedding_facts": walks + _facts(
            vectors="SELECT count(*) FROM (SELECT item FROM walk GROUP BY item HAVING count(*) >= 5)", wrong_sizes="0", not_finite="0"),
        "embedding_chain_facts": seq + _facts(
            user_vectors="SELECT count(DISTINCT userId) FROM ratings WHERE productId IN (SELECT productId FROM vocab)", wrong_sizes="0",
            neighbours="SELECT least(5, count(*)) FROM vocab", negative_distances="0", at_the_query="1"),
        "similar_items_facts": seq + _facts(rows_out="SELECT least(20, count(*) - 1) FROM vocab", words="SELECT least(20, count(*) - 1) FROM vocab",
                                            no_cosine="0"),
        "cooccurrence_facts": with_views(RATINGS, POSITIVE_SEQ, NEAR, ASSOCIATIONS) + _facts(
            vectors="SELECT count(DISTINCT a) FROM associated", wrong_sizes="0", not_finite="0"),
        "walk_vector_facts": walks + ", " + _near("item", "walk", "w", "step") + ",\n" + ASSOCIATIONS + "\n" + _facts(
            vectors="SELECT count(DISTINCT a) FROM associated", wrong_sizes="0", not_finite="0"),
        "ivf_facts": _facts(
            indexed="SELECT count(*) FROM embeddings", distinct_ids="SELECT count(*) FROM embeddings", queries="SELECT count(*) FROM embeddings",
            rows_out="SELECT count(*) * least(20, count(*) - 1) FROM embeddings", wrong_scores="0", recall_below_90_percent="0"),
        "lsh_facts": _facts(hashed="SELECT count(*) FROM embeddings", wrong_tables="0", finds_itself="1", too_many="0", wrong_distances="0"),
        "bucket_facts": stats + _facts(products="SELECT count(*) FROM p", out_of_bounds="0",
                                       at_bounds="SELECT count(*) FROM p WHERE m = (SELECT min(m) FROM p) OR m = (SELECT max(m) FROM p)", overlaps="0"),
        "sketch_facts": with_views(RATINGS) + _facts(
            days="SELECT count(DISTINCT ts // 86400) FROM ratings", ratings="SELECT count(*) FROM ratings", split_is_off="0", bounds="99", bounds_off="0"),
        "time_split_facts": sample + _facts(samples="SELECT count(*) FROM x", share_is_off="0", parts_overlap="0"),
        "ctr_facts": sample + _facts(**ctr),
    }


# ---------------------------------------------------------------- model baselines
def baseline_rmse_sql() -> str:
    part = below(7, 0.8, "userId", "productId", "ts", "l_orderkey", "l_linenumber")
    return with_views(RATINGS) + f""", s AS (SELECT *, CASE WHEN {part} THEN 'train' ELSE 'test' END AS split FROM ratings),
        m AS (SELECT productId, avg(rating) AS pm FROM s WHERE split = 'train' GROUP BY productId)
        SELECT round(sqrt(avg((pm - rating) * (pm - rating))), 6) AS rmse, count(*) AS n
        FROM s JOIN m USING (productId) WHERE split = 'test'"""


def baseline_auc_sql() -> str:
    return baseline_logloss_sql().rsplit("SELECT round(avg(", 1)[0] + """, g AS (
        SELECT p, sum(label) AS pos, count(*) AS n FROM t GROUP BY p),
        c AS (SELECT *, sum(pos) OVER above AS tp, sum(n) OVER above AS seen, (SELECT sum(pos) FROM g) AS np, (SELECT sum(n - pos) FROM g) AS nn
              FROM g WINDOW above AS (ORDER BY p DESC)),
        d AS (SELECT *, CAST(tp AS DOUBLE) / seen AS precision,
                     CASE WHEN seen > n THEN CAST(tp - pos AS DOUBLE) / (seen - n) ELSE CAST(tp AS DOUBLE) / seen END AS last FROM c)
        SELECT round(sum((n - pos) * (tp - pos + CAST(pos AS DOUBLE) / 2)) / (any_value(np) * any_value(nn)), 6) AS auc_roc,
               round(sum(pos * (precision + last) / 2) / any_value(np), 6) AS auc_pr FROM d"""


def sample_file_sql() -> dict[str, str]:
    kind = draw(9, "userId", "productId", '"timestamp"') + " % 20"
    rows = f"WITH x AS (SELECT *, {kind} AS kind FROM ({training_samples_sql()}))\n"
    kept = f"""s AS (SELECT * FROM ({training_samples_sql()}) WHERE {below(0, 0.1, 'userId', 'productId', '"timestamp"')}),
        counted AS (SELECT "timestamp" AS t, sum(count(*)) OVER (ORDER BY "timestamp") AS hi FROM s GROUP BY "timestamp")"""
    return {
        "samples_read": rows + """SELECT userId, productId, "timestamp", label, CASE WHEN kind = 3 THEN 0 ELSE releaseYear END AS releaseYear,
            round(CAST(replace(productAvgRating, ',', '') AS DOUBLE), 6) AS productAvgRating, coalesce(userType5, '') AS userType5
            FROM x WHERE kind NOT IN (0, 1, 2)""",
        "samples_skipped": rows + """SELECT count(*) AS rows, count(*) FILTER (kind IN (0, 1)) AS wrong_fields,
            count(*) FILTER (kind = 2) AS unreadable, count(*) FILTER (kind NOT IN (0, 1, 2)) AS kept FROM x""",
        "save_by_time": f"""WITH {kept}
            SELECT userId, productId, "timestamp", label, CASE WHEN "timestamp" <= (
                SELECT min(t) FROM counted WHERE hi >= 0.8 * (SELECT count(*) FROM s)) THEN 'train' ELSE 'test' END AS split FROM s""",
    }


def field_slots_sql(words=("ECONOMY", "PROMO", "STANDARD", "blue", "gear", "red"), products: int = 1001, users: int = 30001) -> str:
    types = [f"productType{i}" for i in (1, 2, 3)] + [f"userType{i}" for i in (1, 2, 3, 4, 5)]
    listed, width = "[" + ", ".join(f"'{w}'" for w in words) + "]", len(words) + 1
    slots = [f"CASE WHEN productId BETWEEN 0 AND {products - 1} THEN 7 + productId END",
             f"CASE WHEN userId BETWEEN 0 AND {users - 1} THEN {7 + products} + userId END"]
    for j, t in enumerate(types):
        place = f"CASE WHEN list_contains({listed}, {t}) THEN list_position({listed}, {t}) - 1 ELSE {width - 1} END"
        slots.append(f"{7 + products + users + j * width} + {place}")
    each = ", ".join(f"CAST({x} AS VARCHAR)" for x in slots)
    full = 7 + products + users + len(types) * width + 10000
    return f"""SELECT userId, productId, "timestamp", {full} AS width, concat_ws(',', {each}) AS slots FROM ({training_samples_sql()})"""


def baseline_logloss_sql() -> str:
    part = below(1, 0.8, "userId", "productId", '"timestamp"')
    return with_views(*SAMPLE_BASE, sample_windows()) + f""", s0 AS (
        SELECT userId, productId, ts AS "timestamp", label FROM ranked),
        s AS (SELECT *, CASE WHEN {part} THEN 'train' ELSE 'test' END AS split FROM s0),
        r AS (SELECT productId, avg(label) AS p FROM s WHERE split = 'train' GROUP BY productId),
        t AS (SELECT label, p, least(greatest(p, 1e-15), 1 - 1e-15) AS pc FROM s JOIN r USING (productId) WHERE split = 'test')
        SELECT round(avg(-(label * ln(pc) + (1 - label) * ln(1 - pc))), 6) AS logloss,
               round(avg(CASE WHEN (CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               count(*) AS n FROM t"""
