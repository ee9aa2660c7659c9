"""The catalog's queries as SQL over the same tables, in DuckDB's dialect."""

from __future__ import annotations

# Parameters shared with the Spark side.
DIM = 64
CELLS = 16
NPROBE = 4
RECALL = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
LINE_BREAKERS = "[\t\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"

# Fixed value: the characters at which text is split into tokens.
BLANK = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]+"
)
# Fixed value: the characters that a plain tab-separated file cannot hold.
BREAKS = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{BLANK}'), lambda x: x <> '')"


def _round(value: str) -> str:
    return f"round({value}, 6)"


def _cos(a: str, b: str) -> str:
    norm = f"sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))"
    return f"list_dot_product({a}, {b}) / nullif({norm}, 0)"


# Named parts; `_with` puts the wanted ones, and what they need, before a statement.
_PARTS: dict[str, tuple[str, str]] = {
    # name: (needs, body)
    "dtok": ("", f"SELECT doc_id, {_tokens('text')} AS toks FROM documents"),
    "dl": ("dtok", "SELECT doc_id, CAST(len(toks) AS INT) AS dl FROM dtok"),
    "post": (
        "dtok",
        "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM dtok)"
        " GROUP BY doc_id, term",
    ),
    "cs": ("dl", "SELECT count(*) AS n, avg(dl) AS avgdl FROM dl"),
    "dfs": ("post", "SELECT term, count(*) AS df FROM post GROUP BY term"),
    "idfs": (
        "dfs cs",
        "SELECT term, df, ln((n - df + 0.5) / (df + 0.5) + 1) AS idf FROM dfs, cs",
    ),
    "qt": (
        "",
        "SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, "
        f"unnest({_tokens('text')}) AS term FROM benchmark) GROUP BY query_id, term",
    ),
    "contrib": (
        "qt idfs post dl cs",
        "SELECT query_id, post.doc_id, post.term, idf * qtf * tf * 2.5"
        " / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) AS w FROM qt JOIN idfs ON qt.term = idfs.term"
        " JOIN post ON post.term = qt.term JOIN dl ON dl.doc_id = post.doc_id, cs",
    ),
    "bm": (
        "contrib",
        f"SELECT query_id, doc_id, {_round('sum(w)')} AS score FROM contrib"
        " GROUP BY query_id, doc_id",
    ),
    "bmr": (
        "bm",
        "SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
        " ORDER BY score DESC, doc_id) AS INT) AS rank FROM bm",
    ),
    # Vectors of the embeddings table.
    "ev": ("", "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"),
    "ecent": (
        "ev",
        "SELECT CAST(row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS INT)"
        f" AS cell, e FROM ev QUALIFY cell < {CELLS}",
    ),
    "eplace": (
        "ev ecent",
        "SELECT ev.id, cell, CAST(row_number() OVER (PARTITION BY ev.id ORDER BY"
        f" coalesce({_round(_cos('ev.e', 'ecent.e'))}, 0) DESC, cell) AS INT) AS place"
        " FROM ev, ecent",
    ),
    "ecos": (
        "ev",
        f"SELECT q.id AS query_id, d.id AS doc_id, {_round(_cos('q.e', 'd.e'))} AS score"
        " FROM ev q, ev d",
    ),
    "ecosr": (
        "ecos",
        "SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
        " ORDER BY score DESC NULLS LAST, doc_id) AS INT) AS rank FROM ecos",
    ),
    # Hashed token counts of documents and queries.
    "dslot": (
        "post",
        f"SELECT doc_id, CAST('0x' || substr(md5(term), 1, 4) AS INT) % {DIM} AS slot,"
        " sum(tf) AS v FROM post GROUP BY ALL",
    ),
    "dvec": (
        "dslot",
        "SELECT d.doc_id, list(CAST(coalesce(v, 0) AS DOUBLE) ORDER BY i) AS e"
        f" FROM documents d CROSS JOIN range({DIM}) r(i)"
        " LEFT JOIN dslot s ON s.doc_id = d.doc_id AND s.slot = i GROUP BY d.doc_id",
    ),
    "qslot": (
        "qt",
        f"SELECT query_id, CAST('0x' || substr(md5(term), 1, 4) AS INT) % {DIM} AS slot,"
        " sum(qtf) AS v FROM qt GROUP BY ALL",
    ),
    "qvec": (
        "qslot",
        "SELECT q.item_id AS query_id, list(CAST(coalesce(v, 0) AS DOUBLE) ORDER BY i) AS e"
        f" FROM benchmark q CROSS JOIN range({DIM}) r(i)"
        " LEFT JOIN qslot s ON s.query_id = q.item_id AND s.slot = i GROUP BY q.item_id",
    ),
    "tcent": (
        "dvec",
        "SELECT CAST(row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1"
        f" AS INT) AS cell, e FROM dvec QUALIFY cell < {CELLS}",
    ),
    "dcell": (
        "dvec tcent",
        "SELECT doc_id, cell FROM (SELECT d.doc_id, cell, row_number() OVER (PARTITION BY"
        f" d.doc_id ORDER BY coalesce({_round(_cos('d.e', 'c.e'))}, 0) DESC, cell) AS place"
        " FROM dvec d, tcent c) WHERE place = 1",
    ),
    "qprobe": (
        "qvec tcent",
        "SELECT query_id, cell FROM (SELECT q.query_id, cell, row_number() OVER (PARTITION BY"
        f" q.query_id ORDER BY coalesce({_round(_cos('q.e', 'c.e'))}, 0) DESC, cell) AS place"
        f" FROM qvec q, tcent c) WHERE place <= {NPROBE}",
    ),
    "tcos": (
        "dvec qvec",
        f"SELECT query_id, doc_id, {_round(_cos('q.e', 'd.e'))} AS score FROM qvec q, dvec d",
    ),
    "tcosr": (
        "tcos",
        "SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
        " ORDER BY score DESC NULLS LAST, doc_id) AS INT) AS rank FROM tcos",
    ),
    "tapp": (
        "tcos qprobe dcell",
        "SELECT query_id, doc_id, coalesce(score, 0) AS score FROM tcos JOIN dcell USING (doc_id)"
        " JOIN qprobe USING (query_id, cell)",
    ),
    "tappr": (
        "tapp",
        "SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
        " ORDER BY score DESC, doc_id) AS INT) AS rank FROM tapp",
    ),
    # Share of a query's distinct tokens found in a document.
    "asked": ("qt", "SELECT query_id, count(*) AS terms FROM qt GROUP BY query_id"),
    "found": (
        "qt post",
        "SELECT query_id, doc_id, count(*) AS found FROM qt JOIN post USING (term) GROUP BY ALL",
    ),
    "mod": (
        "asked found",
        f"SELECT b.item_id AS query_id, d.doc_id, {_round('coalesce(found / terms, 0)')} AS score"
        " FROM benchmark b CROSS JOIN documents d LEFT JOIN asked a ON a.query_id = b.item_id"
        " LEFT JOIN found f ON f.query_id = b.item_id AND f.doc_id = d.doc_id",
    ),
    # Judged runs from orders.
    "bought": (
        "",
        "SELECT o_custkey AS query_id, l_partkey AS doc_id, l_extendedprice AS price,"
        " l_returnflag AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    ),
    "spent": (
        "bought",
        "SELECT query_id, doc_id, round(sum(price), 2) AS score FROM bought"
        " GROUP BY query_id, doc_id",
    ),
    "spentr": (
        "spent",
        "SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
        " ORDER BY score DESC, doc_id) AS INT) AS rank FROM spent",
    ),
    "brun": ("spentr", "SELECT * FROM spentr"),
    "bqrels": (
        "bought",
        "SELECT query_id, doc_id, CAST(max(CASE flag WHEN 'N' THEN 2 WHEN 'A' THEN 1 ELSE 0 END)"
        " AS INT) AS rel FROM bought GROUP BY query_id, doc_id",
    ),
}


def _with(needs: str, statement: str, **extra: str) -> str:
    """A statement behind the parts it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in _PARTS[name][0].split():
            add(need)
        order.append(name)

    for name in needs.split():
        add(name)
    parts = [f"{name} AS ({_PARTS[name][1]})" for name in order]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return f"WITH {', '.join(parts)} {statement}" if parts else statement


# Text and term statistics.
TOKENS = _with(
    "dtok",
    "SELECT doc_id, CAST(pos - 1 AS INT) AS pos, term FROM (SELECT doc_id, unnest(toks) AS term,"
    " generate_subscripts(toks, 1) AS pos FROM dtok)",
)
TERM_FREQUENCY = _with("post", "SELECT doc_id, term, tf FROM post")
DOCUMENT_FREQUENCY = _with("dfs", "SELECT term, df FROM dfs")
DOC_LENGTH = _with("dl", "SELECT doc_id, dl FROM dl")
CORPUS_STATS = _with("cs", "SELECT n, round(avgdl, 6) AS avgdl FROM cs")
IDF = _with("idfs", "SELECT term, df, round(idf, 6) AS idf FROM idfs")
QUERY_TERM_COUNTS = _with("qt", "SELECT query_id, term, qtf FROM qt")
KNOWN_QUERY_TERMS = _with(
    "qt dfs", "SELECT query_id, term, qtf, df FROM qt JOIN dfs USING (term)"
)
BM25_TERM_WEIGHTS = _with(
    "contrib tcosr",
    "SELECT query_id, doc_id, term, round(w, 6) AS weight FROM contrib"
    " JOIN (SELECT query_id, doc_id FROM tcosr WHERE rank <= 100) USING (query_id, doc_id)",
)
BM25_SCORES = _with(
    "bm tcosr",
    "SELECT query_id, doc_id, bm.score FROM bm"
    " JOIN (SELECT query_id, doc_id FROM tcosr WHERE rank <= 100) USING (query_id, doc_id)",
)

# Vectors.
VECTOR_NORMS = _with(
    "ev", "SELECT id AS vec_id, round(sqrt(list_dot_product(e, e)), 6) AS norm FROM ev"
)
UNIT_VECTORS = _with(
    "ev",
    "SELECT vec_id, CAST(pos - 1 AS INT) AS pos, round(x / nullif(n, 0), 6) AS x FROM"
    " (SELECT id AS vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS pos,"
    " sqrt(list_dot_product(e, e)) AS n FROM ev)",
)
NEIGHBOUR_PRODUCTS = _with(
    "ev",
    "SELECT a.id AS vec_id, round(list_dot_product(a.e, b.e), 6) AS dot,"
    f" {_round(_cos('a.e', 'b.e'))} AS cosine FROM ev a JOIN ev b ON b.id = a.id + 1",
)
_UNROLLED = (
    "SELECT doc_id, CAST(pos - 1 AS INT) AS pos, x FROM (SELECT doc_id, unnest(e) AS x,"
    " generate_subscripts(e, 1) AS pos FROM dvec{where})"
)
ENCODED_DOCUMENTS = _with("dvec", _UNROLLED.format(where=""))
ENCODED_SUBSET = _with(
    "dvec", _UNROLLED.format(where=" WHERE doc_id IN (SELECT doc_id FROM labels)")
)
ENCODED_FILE = ENCODED_SUBSET.replace(
    "SELECT doc_id, CAST(pos", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(pos"
)
NEAREST_CELLS = _with(
    "eplace", f"SELECT id AS query_id, place, cell FROM eplace WHERE place <= {NPROBE}"
)
CELL_ASSIGNMENT = _with("eplace", "SELECT id AS doc_id, cell FROM eplace WHERE place = 1")

# Collections, queries and their parts.
COLLECTION_SUBSET = (
    "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"
)
COLLECTION_WHOLE = "SELECT doc_id, text FROM documents"
DOCS_WITH_VECTOR = (
    "SELECT doc_id, CAST(len(embedding) AS INT) AS dim FROM documents"
    " JOIN embeddings ON doc_id = vec_id WHERE embedding IS NOT NULL"
)
ATTACHED_TEXTS = _with(
    "brun",
    "SELECT query_id, brun.doc_id, rank, CAST(length(text) AS INT) AS n_chars FROM brun"
    " LEFT JOIN documents USING (doc_id)",
)
CORPUS_ASSEMBLY = (
    "SELECT coalesce(doc_id, vec_id) AS doc_id, text IS NOT NULL AS has_text,"
    " embedding IS NOT NULL AS has_vector FROM documents"
    " FULL JOIN embeddings ON doc_id = vec_id"
)
ALL_IDS = (
    "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents"
    " UNION SELECT vec_id FROM embeddings"
)

# Files.
_FLAT = f"regexp_replace(text, '{BREAKS}', ' ', 'g')"
READ_COLLECTION = f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_FLAT} AS text FROM documents"
READ_COLLECTION_QUOTED = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents"
READ_COLLECTION_SUBSET = READ_COLLECTION + " WHERE doc_id IN (SELECT doc_id FROM labels)"
READ_QUERIES = (
    f"SELECT CAST(doc_id AS VARCHAR) AS query_id, {_FLAT} AS text FROM documents"
    " WHERE doc_id NOT IN (SELECT item_id FROM benchmark)"
    f" UNION ALL SELECT CAST(item_id AS VARCHAR), {_FLAT} FROM benchmark"
)
READ_VECTORS = (
    "SELECT query_id, CAST(pos - 1 AS INT) AS pos, round(CAST(x AS DOUBLE), 6) AS x FROM"
    " (SELECT vec_id AS query_id, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM"
    " (SELECT vec_id, CASE WHEN vec_id IN (SELECT item_id FROM benchmark)"
    " THEN list_reverse(embedding) ELSE embedding END AS e FROM embeddings))"
)
READ_QRELS = (
    "SELECT CAST(l_orderkey AS VARCHAR) AS query_id, CAST(l_partkey AS VARCHAR) AS doc_id,"
    " CAST(trunc(arg_max(l_quantity, l_linenumber * 1000 + l_quantity)) AS INT) AS rel"
    " FROM lineitem"
    " GROUP BY l_orderkey, l_partkey"
)
READ_QUERY_IDS = "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS query_id FROM lineitem"
RUN_LINES = _with(
    "brun",
    "SELECT 'bought' AS run_name, printf('%d' || chr(9) || '0' || chr(9) || '%d' || chr(9)"
    " || '%d' || chr(9) || '%.6f' || chr(9) || '%s', query_id, doc_id, rank, score, 'run_1')"
    " AS value FROM brun",
)
RUN_ROUND_TRIP = _with(
    "bmr",
    "SELECT 'qrels.one.tsv-BM25(1.5-0.75)-[10]-' || c || '.txt' AS run_name,"
    " CAST(query_id AS VARCHAR) AS query_id, CAST(doc_id AS VARCHAR) AS doc_id, rank, score,"
    " 'run_1' AS run_id FROM bmr JOIN (VALUES (10), (3)) v(c) ON rank <= c",
)
RUN_CUTOFFS = _with(
    "brun",
    "SELECT CAST(c AS INT) AS cutoff, query_id, doc_id, rank FROM brun"
    " JOIN (VALUES (20), (5), (1)) v(c) ON rank <= c",
)
RUN_NAMES = (
    "SELECT DISTINCT source, lang, replace(replace('qrels.' || source || '.' || lang ||"
    " '.tsv-HNSW(8-200-50), C(cross-encoder/ms-marco-TinyBERT-L-2-v2)-[1000,100]-10.txt',"
    " ' ', ''), '/', '-') AS run_name,"
    " split_part(replace('qrels.' || source || '.' || lang || '.tsv', ' ', ''), '-', 1)"
    " AS qrels_name FROM documents"
)


def _metrics(run: str, qrels: str, order: str, by: str = "") -> dict[str, str]:
    """Parts that score ``run`` against ``qrels``; ``by`` names further key columns."""
    on = " AND ".join(f"r.{c} = q.{c}" for c in [*by.replace(" ", "").split(","), "query_id"]
                      if c and c != "run_name")
    key = f"{by + ', ' if by else ''}query_id"
    rkey = ", ".join(f"r.{c.strip()}" for c in key.split(","))
    qkey = ", ".join(c.strip() for c in key.split(",") if c.strip() != "run_name")
    recall = ", ".join(
        f"count(*) FILTER (rel >= 1 AND rk <= {c}) / nullif(any_value(n_rel), 0) AS recall_{c}"
        for c in RECALL
    )
    return {
        "judged": f"SELECT r.*, coalesce(q.rel, 0) AS rel FROM {run} r LEFT JOIN {qrels} q"
                  f" ON {on} AND r.doc_id = q.doc_id",
        "ordered": f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rk"
                   " FROM judged",
        "counted": "SELECT *, count(*) FILTER (rel >= 1) OVER"
                   f" (PARTITION BY {key} ORDER BY rk) AS hits FROM ordered",
        "best": f"SELECT *, row_number() OVER (PARTITION BY {qkey} ORDER BY rel DESC) AS place"
                f" FROM {qrels}",
        "ideal": f"SELECT {qkey}, count(*) FILTER (rel >= 1) AS n_rel,"
                 " coalesce(sum(rel / log2(place + 1)) FILTER (rel >= 1), 0) AS ideal FROM best"
                 f" GROUP BY {qkey}",
        "wide": f"SELECT {rkey}, coalesce(sum(hits / rk) FILTER (rel >= 1)"
                " / nullif(any_value(n_rel), 0), 0) AS map,"
                " coalesce(sum(rel / log2(rk + 1)) FILTER (rel >= 1)"
                " / nullif(any_value(ideal), 0), 0) AS ndcg,"
                " coalesce(1 / min(rk) FILTER (rel >= 1), 0) AS recip_rank,"
                f" {recall} FROM counted r JOIN ideal q ON {on} GROUP BY {rkey}",
        "long": "SELECT " + key + ", measure, round(coalesce(value, 0), 6) AS value FROM (UNPIVOT"
                " (SELECT " + key + ", map, ndcg, recip_rank, "
                + ", ".join(f"coalesce(recall_{c}, 0) AS recall_{c}" for c in RECALL)
                + " FROM wide) ON map, ndcg, recip_rank, "
                + ", ".join(f"recall_{c}" for c in RECALL)
                + " INTO NAME measure VALUE value)",
    }


_BY_SCORE = "score DESC, CAST(doc_id AS VARCHAR) DESC"


def _bought(statement: str, order: str = _BY_SCORE) -> str:
    return _with("brun bqrels", statement, **_metrics("brun", "bqrels", order))


# Mean of six-decimal values, in millionths, half rounded up.
_MEAN = (
    "floor((2 * sum(CAST(round(value * 1000000) AS BIGINT)) + count(value)) / (2 * count(value)))"
    " / 1000000"
)
METRICS_PER_QUERY = _bought("SELECT query_id, measure, value FROM long")
METRICS_BY_RANK = _bought("SELECT query_id, measure, value FROM long", "doc_id")
METRICS_MEAN = _bought(f"SELECT measure, {_MEAN} AS value FROM long GROUP BY measure")
METRICS_ROUND_TRIP = METRICS_MEAN
RUNNING_HITS = _bought(
    "SELECT query_id, doc_id, CAST(rk AS INT) AS rank, CAST(hits AS BIGINT) AS hits FROM counted"
)
IDEAL_GAINS = _bought("SELECT query_id, n_rel, round(ideal, 6) AS ideal FROM ideal")
JUDGED_RUN = _bought("SELECT query_id, doc_id, rank, rel FROM judged")


def metric(name: str) -> str:
    return _bought(f"SELECT query_id, measure, value FROM long WHERE measure = '{name}'")


# Scorers and their chains.
def _top(source: str, k: int) -> str:
    return _with(source, f"SELECT query_id, doc_id, score, rank FROM {source} WHERE rank <= {k}")


def _second(first: str, k1: int, scores: str, k2: int) -> str:
    """Re-rank the first ``k1`` of one ranking by the scores of another."""
    return _with(
        f"{first} {scores}",
        f"SELECT query_id, doc_id, score, rank FROM second WHERE rank <= {k2}",
        second="SELECT f.query_id, f.doc_id, s.score, CAST(row_number() OVER (PARTITION BY"
               " f.query_id ORDER BY s.score DESC NULLS LAST, f.rank, f.doc_id) AS INT) AS rank"
               f" FROM {first} f JOIN {scores} s ON s.query_id = f.query_id"
               f" AND s.doc_id = f.doc_id WHERE f.rank <= {k1}",
    )


def _second_bm25(first: str, k1: int, k2: int) -> str:
    return _with(
        f"{first} bm",
        f"SELECT query_id, doc_id, score, rank FROM second WHERE rank <= {k2}",
        second="SELECT f.query_id, f.doc_id, coalesce(s.score, 0) AS score,"
               " CAST(row_number() OVER (PARTITION BY f.query_id ORDER BY coalesce(s.score, 0)"
               f" DESC, f.rank, f.doc_id) AS INT) AS rank FROM {first} f LEFT JOIN bm s"
               f" ON s.query_id = f.query_id AND s.doc_id = f.doc_id WHERE f.rank <= {k1}",
    )


def _pooled(scores: str) -> str:
    """The best ten of the labelled documents."""
    return _with(
        scores,
        "SELECT query_id, doc_id, score, rank FROM pooled WHERE rank <= 10",
        pooled="SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id"
               f" ORDER BY score DESC NULLS LAST, doc_id) AS INT) AS rank FROM {scores}"
               " WHERE doc_id IN (SELECT doc_id FROM labels)",
    )


BM25_TOP10 = _top("bmr", 10)
BM25_TOP1000 = _top("bmr", 1000)
RANK_CUTOFF = _top("bmr", 3)
BM25_RERANK_PADDED = _second_bm25("tcosr", 500, 500)
BM25_RERANK_MATCHED = _second("tcosr", 500, "bm", 500)
BM25_IN_POOL = _pooled("bm")
TEXT_COSINE_IN_POOL = _pooled("tcos")
MODEL_IN_POOL = _pooled("mod")
COSINE_TOP100 = _top("ecosr", 100)
COSINE_TOP10 = _top("ecosr", 10)
_VISITED = (
    "SELECT e.query_id, e.doc_id, coalesce(score, 0) AS score{rank} FROM {source} e JOIN eplace d"
    " ON d.id = e.doc_id AND d.place = 1 JOIN eplace q ON q.id = e.query_id AND q.cell = d.cell"
    f" AND q.place <= {NPROBE}"
)
APPROX_TOP10 = _with(
    "ecos eplace",
    "SELECT query_id, doc_id, score, CAST(rk AS INT) AS rank FROM (SELECT *, row_number() OVER"
    " (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rk FROM visited) WHERE rk <= 10",
    visited=_VISITED.format(rank="", source="ecos"),
)
APPROX_RESTRICTED = _with(
    "ecosr eplace",
    "SELECT query_id, doc_id, score, CAST(rk AS INT) AS rank FROM (SELECT query_id, doc_id, score,"
    " row_number() OVER (PARTITION BY query_id ORDER BY score DESC, before, doc_id) AS rk"
    " FROM visited WHERE before <= 100) WHERE rk <= 10",
    visited=_VISITED.format(rank=", rank AS before", source="ecosr"),
)
MODEL_TOP10 = _with(
    "mod",
    "SELECT query_id, doc_id, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY"
    " query_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM mod) WHERE rank <= 10",
)
TEXT_COSINE_TOP10 = _top("tcosr", 10)
TEXT_APPROX_TOP10 = _top("tappr", 10)
BM25_THEN_COSINE = _second("bmr", 100, "tcos", 10)
BM25_THEN_MODEL = _second("bmr", 100, "mod", 10)
APPROX_THEN_COSINE = _second("tappr", 100, "tcos", 10)
APPROX_THEN_MODEL = _second("tappr", 100, "mod", 10)
APPROX_THEN_BM25 = _second_bm25("tappr", 100, 10)
COSINE_THEN_MODEL = _second("tcosr", 100, "mod", 10)
COSINE_THEN_BM25 = _second_bm25("tcosr", 100, 10)
OWN_STAGE = _with(
    "bmr",
    "SELECT query_id, doc_id, score, rank FROM longest WHERE rank <= 10",
    longest="SELECT query_id, b.doc_id, CAST(length(text) AS DOUBLE) AS score,"
            " CAST(row_number() OVER (PARTITION BY query_id ORDER BY length(text) DESC, rank,"
            " b.doc_id) AS INT) AS rank FROM bmr b JOIN documents USING (doc_id)"
            " WHERE b.rank <= 100",
)
NO_STAGE = _with(
    "brun", "SELECT query_id, doc_id, CAST(NULL AS DOUBLE) AS score, rank FROM brun"
)

# Ranks and metrics.
RANKS = _with("spentr", "SELECT query_id, doc_id, score, rank FROM spentr")
RANK_DISCOUNTS = _with(
    "brun", "SELECT query_id, doc_id, rank, round(1 / log2(rank + 1), 6) AS discount FROM brun"
)

# Experiments: two rankings, two judgment sets, two cutoffs.
_EXPERIMENT = {
    "holds": "SELECT item_id AS query_id, doc_id, coalesce(quality, 1) AS good,"
             " 1 - coalesce(toxic, 0) AS clean FROM benchmark b JOIN documents d"
             " ON contains(d.text, b.text) LEFT JOIN labels USING (doc_id)",
    "qrels": "SELECT 'qrels.good.tsv' AS qrels_name, query_id, doc_id, good AS rel FROM holds"
             " UNION ALL SELECT 'qrels.clean.tsv', query_id, doc_id, clean FROM holds",
    "firsts": "SELECT 'BM25(1.5-0.75),Cos()' AS label, query_id, doc_id, rank FROM bmr"
              f" UNION ALL SELECT 'IVF({NPROBE}),Cos()', query_id, doc_id, rank FROM tappr",
    "seconds": "SELECT label, f.query_id, f.doc_id, s.score, CAST(row_number() OVER (PARTITION BY"
               " label, f.query_id ORDER BY s.score DESC NULLS LAST, f.rank, f.doc_id) AS INT)"
               " AS rank FROM firsts f JOIN tcos s ON s.query_id = f.query_id"
               " AND s.doc_id = f.doc_id WHERE f.rank <= 1000",
    "runs": "SELECT qrels_name || '-' || label || '-[1000,100]-' || c || '.txt' AS run_name,"
            " qrels_name, CAST(c AS INT) AS cutoff, s.query_id, s.doc_id, rank, score,"
            " 'run_1' AS run_id FROM seconds s JOIN (VALUES (100), (10)) v(c) ON rank <= c"
            " JOIN (SELECT DISTINCT qrels_name, query_id FROM qrels) j"
            " ON j.query_id = s.query_id",
}
EXPERIMENT_RUNS = _with(
    "bmr tappr tcos",
    "SELECT run_name, qrels_name, cutoff, query_id, doc_id, rank, score, run_id FROM runs",
    **_EXPERIMENT,
)
EXPERIMENT_METRICS = _with(
    "bmr tappr tcos",
    f"SELECT run_name, qrels_name, measure, {_MEAN} AS value FROM long GROUP BY ALL",
    **_EXPERIMENT,
    **_metrics("runs", "qrels", _BY_SCORE, "run_name, qrels_name"),
)
RUNS_WITHOUT_QRELS = (
    "SELECT DISTINCT source || '.' || lang || '-run-10.txt' AS run_name,"
    " split_part(source || '.' || lang, '-', 1) AS qrels_name FROM documents"
    " WHERE split_part(source || '.' || lang, '-', 1) NOT IN (SELECT source || '.' || lang"
    " FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"
)

# Checks.
QUERIES_WITHOUT_TEXT = _with(
    "bought",
    "SELECT DISTINCT doc_id AS query_id FROM bought WHERE doc_id NOT IN"
    " (SELECT doc_id FROM documents WHERE text IS NOT NULL)",
)
QUERIES_WITHOUT_VECTOR = (
    "SELECT DISTINCT doc_id AS query_id FROM documents WHERE doc_id NOT IN"
    " (SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL)"
)
MALFORMED_VECTORS = (
    "WITH v AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN embedding[1:10] ELSE embedding END AS e"
    " FROM documents d LEFT JOIN embeddings ON vec_id = d.doc_id"
    " LEFT JOIN labels l ON l.doc_id = d.doc_id), u AS (SELECT len(e) AS size FROM v"
    " WHERE len(e) > 0 GROUP BY len(e) ORDER BY count(*) DESC, len(e) LIMIT 1)"
    " SELECT doc_id, CAST(len(e) AS INT) AS size, CASE WHEN e IS NULL THEN 'no vector' ELSE"
    " 'other length' END AS problem FROM v WHERE e IS NULL OR len(e) <> (SELECT size FROM u)"
)
LOAD_REPORT = (
    "SELECT 'passages' AS item, count(*) AS n FROM documents UNION ALL"
    " SELECT 'vectors', count(*) FROM embeddings WHERE embedding IS NOT NULL UNION ALL"
    " SELECT 'passages without vector', count(*) FROM documents WHERE doc_id NOT IN"
    " (SELECT vec_id FROM embeddings) UNION ALL"
    " SELECT 'vectors without passage', count(*) FROM embeddings WHERE vec_id NOT IN"
    " (SELECT doc_id FROM documents)"
)
INPUT_CHECKS = (
    "SELECT 'documents' AS item, count(*) > 0 AS usable FROM documents UNION ALL"
    " SELECT 'vectors', count(*) > 0 FROM embeddings WHERE embedding IS NOT NULL UNION ALL"
    " SELECT 'unlabelled_documents', count(*) > 0 FROM documents WHERE doc_id NOT IN"
    " (SELECT doc_id FROM labels) UNION ALL"
    " SELECT 'unlabelled_labels', false"
)
