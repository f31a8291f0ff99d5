"""All queries of the engine's own operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ENGLISH_WORDS, NON_LATIN_PATTERN, STRIP_PATTERN, WORD_PATTERN, contains_any, normalize_for_model, strip
from ..operators import cascade, corpus, export, gold, layout, metrics, route, seeds, student
from ..session import stored
from .frames import SCORER, judged, lines, pairs, routed, table
from .taxonomy import PRODUCTION, SYNTHETIC, SYNTHETIC_LABELS, SYNTHETIC_RECALL

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: Sizes for the synthetic tables, small enough that their chunks and parts are several.
CHUNK, PART = 500, 300


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL of the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _quoted(x: object) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _in(names) -> str:
    return "(" + ", ".join(map(_quoted, names)) + ")"


# ── The common tables of the SQL side ─────────────────────────────────────────────────────────────────


def _norm(column: str) -> str:
    return f"replace(regexp_replace(coalesce({column}, ''), '{STRIP_PATTERN}', '', 'g'), chr(10), ' ')"


_LABELS = sorted(SYNTHETIC_LABELS)
_HITS = ", ".join(f"len(regexp_extract_all(low, {_quoted(SYNTHETIC_LABELS[x])})) AS h{i}" for i, x in enumerate(_LABELS))
_ALL = [f"h{i}" for i in range(len(_LABELS))]
_BEST, _SUM = f"greatest({', '.join(_ALL)})", " + ".join(_ALL)
_CASE = " ".join(f"WHEN h{i} = {_BEST} THEN {_quoted(x)}" for i, x in enumerate(_LABELS))
_DIRECT = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in sorted(SYNTHETIC.direct().items()))

_T = {
    "lines": "SELECT doc_id * 1000000 + pos AS row_id, source AS source_file, english FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS english, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE lang = 'en')",
    "hits": f"SELECT *, {_HITS} FROM (SELECT *, lower({_norm('english')}) AS low FROM lines)",
    "scored": f"SELECT row_id, source_file, english, CASE WHEN {_SUM} = 0 THEN 'c_none' {_CASE} END AS label, CASE WHEN {_SUM} = 0 THEN 0.0::DOUBLE ELSE {_BEST}::DOUBLE / ({_SUM}) END AS score FROM hits",
    "sent": f"SELECT *, CASE WHEN score IS NULL OR score < 0.6 OR label IN {_in(SYNTHETIC.ambiguous())} THEN 'finegrain' WHEN label IN {_in(sorted(SYNTHETIC.direct()))} THEN 'direct' ELSE 'general' END AS route FROM scored",
    "routed": f"SELECT *, CASE route WHEN 'direct' THEN CASE label {_DIRECT} END WHEN 'general' THEN {_quoted(SYNTHETIC.fallback)} END AS domain FROM sent",
    "pairs": "SELECT a.conv_id, a.turn, a.text AS english, b.text AS target FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'",
    "clean": f"SELECT conv_id, turn, english, target FROM (SELECT conv_id, turn, regexp_replace(english, '{STRIP_PATTERN}', '', 'g') AS english, regexp_replace(target, '{STRIP_PATTERN}', '', 'g') AS target FROM pairs) WHERE english <> '' AND target <> ''",
    "judged": "SELECT d.doc_id, d.text, d.lang AS part, (CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END) || (CASE WHEN toxic = 1 THEN '_toxic' ELSE '_clean' END) AS truth, (CASE WHEN regexp_matches(text, '%%%|!!') THEN 'poor' ELSE 'good' END) || (CASE WHEN regexp_matches(lower(text), 'stupid|worthless|idiot|trash') THEN '_toxic' ELSE '_clean' END) AS pred FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "folds": "SELECT *, ((row_number() OVER (PARTITION BY truth ORDER BY md5('7:' || doc_id), doc_id) - 1) % 5)::INT AS fold FROM judged WHERE truth IN (SELECT truth FROM judged GROUP BY truth HAVING count(*) >= 5)",
    "sample500": f"SELECT lang, value FROM (SELECT lang, value, row_number() OVER (PARTITION BY lang ORDER BY doc_id, value) AS n FROM (SELECT lang, doc_id, regexp_replace(text, '{STRIP_PATTERN}', '', 'g') AS value FROM documents) WHERE value <> '') WHERE n <= 500",
    "seeded": f"SELECT row_id, english FROM lines ORDER BY md5('42:' || row_id), row_id LIMIT {200 * len(SYNTHETIC.domains)}",
    "ordered": "SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS ordinal FROM routed",
    "gold_parts": "SELECT row_id, english, domain AS predicted, 'random' AS part, 0 AS rank FROM (SELECT * FROM routed ORDER BY md5('7:' || row_id), row_id LIMIT 200) UNION ALL SELECT row_id, english, domain, 'stratified', 1 FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY md5('7:' || row_id), row_id) AS n FROM routed WHERE domain IS NOT NULL) WHERE n <= 30 UNION ALL SELECT row_id, english, domain, 'recall:' || probe, 2 FROM missed WHERE n <= 12",
    "missed": "SELECT *, row_number() OVER (PARTITION BY probe ORDER BY md5('7:' || row_id), row_id) AS n FROM (" + " UNION ALL ".join(f"SELECT *, {_quoted(d)} AS probe FROM routed WHERE domain <> {_quoted(d)} AND regexp_matches(lower(english), {_quoted('|'.join(k))})" for d, k in SYNTHETIC_RECALL.items()) + ")",
    "gold": "SELECT row_id, english, predicted, part FROM (SELECT *, row_number() OVER (PARTITION BY english ORDER BY rank, md5('7:' || row_id), row_id, part) AS n FROM gold_parts) WHERE n = 1",
}
_NEEDS = {"hits": ["lines"], "scored": ["hits"], "sent": ["scored"], "routed": ["sent"], "clean": ["pairs"], "folds": ["judged"], "seeded": ["lines"], "ordered": ["routed"], "missed": ["routed"], "gold_parts": ["routed", "missed"], "gold": ["gold_parts"]}

_PROBES = list(SYNTHETIC.probes)
_PHITS = ", ".join(f"len(regexp_extract_all(lower(norm), {_quoted('|'.join(SYNTHETIC.probes[d]))})) AS p{i}" for i, d in enumerate(_PROBES))
_PALL = [f"p{i}" for i in range(len(_PROBES))]
_PBEST, _PSUM = f"greatest({', '.join(_PALL)})", " + ".join(_PALL)
_PCASE = " ".join(f"WHEN p{i} = {_PBEST} THEN {_quoted(d)}" for i, d in enumerate(_PROBES))
_STAGE = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in route.STAGES.items())
_T["stage2"] = f"SELECT *, {_PHITS} FROM (SELECT *, {_norm('english')} AS norm FROM routed)"
_T["classified"] = (
    f"SELECT row_id, source_file, english, norm AS text_norm, CASE WHEN norm <> '' THEN label END AS label, CASE WHEN norm <> '' THEN score END AS score, CASE WHEN norm <> '' THEN route END AS route, "
    f"CASE WHEN norm = '' THEN NULL WHEN route <> 'finegrain' THEN domain WHEN {_PSUM} = 0 THEN {_quoted(SYNTHETIC.fallback)} {_PCASE} END AS domain, "
    f"CASE WHEN norm = '' THEN {_quoted(route.STAGE_EMPTY)} ELSE CASE route {_STAGE} END END AS stage, "
    f"CASE WHEN norm = '' THEN NULL WHEN route <> 'finegrain' THEN score WHEN {_PSUM} = 0 THEN 0.0 ELSE round({_PBEST}::DOUBLE / ({_PSUM}), 4) END AS confidence FROM stage2"
)
_NEEDS |= {"stage2": ["routed"], "classified": ["stage2"]}


def _sql(body: str, *needs: str) -> str:
    """``body`` behind the common tables it needs, and those that they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS.get(name, []):
            add(x)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    return ("WITH " + ", ".join(f"{n} AS ({_T[n]})" for n in order) + " " if order else "") + body


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.classify(lines(spark, sf_dir), SYNTHETIC, SCORER, cascade.keyword_stage2(SYNTHETIC))


# ── Distributions and routing ─────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT domain, count(*) AS pairs, round(100.0 * count(*) / (SELECT count(*) FROM routed), 2)::DOUBLE AS share FROM routed WHERE domain IS NOT NULL GROUP BY domain", "routed"))
def domain_distribution(spark, sf_dir):
    return export.domain_distribution(routed(spark, sf_dir))


@query(_sql("SELECT route, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM routed), 2)::DOUBLE AS share FROM routed GROUP BY route", "routed"))
def route_mix(spark, sf_dir):
    return seeds.distribution(routed(spark, sf_dir), "route")


@query(_sql("SELECT count(*) AS rows, count(*) FILTER (route = 'finegrain') AS finegrained, round(100.0 * count(*) FILTER (route = 'finegrain') / count(*), 2)::DOUBLE AS share FROM routed", "routed"))
def finegrain_share(spark, sf_dir):
    fine = F.count_if(F.col("route") == "finegrain")
    return routed(spark, sf_dir).agg(F.count("*").alias("rows"), fine.alias("finegrained"), F.round(100.0 * fine / F.count("*"), 2).alias("share"))


@query("SELECT source, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM documents WHERE source IS NOT NULL), 2)::DOUBLE AS share FROM documents WHERE source IS NOT NULL GROUP BY source")
def source_counts(spark, sf_dir):
    return seeds.distribution(table(spark, sf_dir, "documents"), "source")


@query(_sql("SELECT row_id, label, round(score, 6) AS score FROM scored", "scored"))
def coarse_score(spark, sf_dir):
    return SCORER.score(lines(spark, sf_dir)).select("row_id", "label", F.round("score", 6).alias("score"))


@query(_sql("SELECT row_id, label, route, domain FROM routed", "routed"))
def route_rows(spark, sf_dir):
    return routed(spark, sf_dir).select("row_id", "label", "route", "domain")


@query(_sql(f"SELECT CASE route {_STAGE} END AS stage, count(*) AS rows FROM routed GROUP BY 1", "routed"))
def stage_label(spark, sf_dir):
    return routed(spark, sf_dir).groupBy(route.stage_of(F.col("route")).alias("stage")).agg(F.count("*").alias("rows"))


@query(_sql("SELECT row_id, label FROM routed WHERE route = 'finegrain'", "routed"))
def finegrain_rows(spark, sf_dir):
    return routed(spark, sf_dir).where("route = 'finegrain'").select("row_id", "label")


# The expected routing and prompt of the production taxonomy, written out rather than derived from it.
_EXPECTED_ROUTING = """WITH claimed(label, outcome, domain, claimed_by) AS (VALUES
('Computers_and_Electronics', 'direct', 'Tech', 'Tech'), ('Internet_and_Telecom', 'direct', 'Tech', 'Tech'),
('Health', 'direct', 'Health', 'Health'), ('Jobs_and_Education', 'direct', 'Education', 'Education'),
('Law_and_Government', 'ambiguous', NULL, 'Admin/Law'), ('Business_and_Industrial', 'ambiguous', NULL, 'Agriculture'),
('Food_and_Drink', 'ambiguous', NULL, 'Agriculture'), ('Science', 'ambiguous', NULL, 'Climate'),
('Travel_and_Transportation', 'ambiguous', NULL, 'Tourism')),
unclaimed(label) AS (VALUES ('Adult'), ('Arts_and_Entertainment'), ('Autos_and_Vehicles'), ('Beauty_and_Fitness'), ('Books_and_Literature'),
('Finance'), ('Games'), ('Hobbies_and_Leisure'), ('Home_and_Garden'), ('News'), ('Online_Communities'), ('People_and_Society'),
('Pets_and_Animals'), ('Real_Estate'), ('Sensitive_Subjects'), ('Shopping'), ('Sports'))
SELECT * FROM claimed UNION ALL SELECT label, 'general', 'General', '' FROM unclaimed"""

_EXPECTED_PROMPT = """Classify this English sentence into exactly one domain.

- Tech: computing, software, electronics, telecom, the internet
- Agriculture: farming, crops, livestock, irrigation, food production
- Climate: weather, environment, climate change, natural disasters
- Tourism: travel, hospitality, destinations, heritage sites, trekking
- Admin: government administration and public services - an office issuing, registering, applying or announcing something
- Health: medicine, disease, treatment, hospitals, public health
- Law: legislation, courts and legal process - a statute, a case, a judgment, a legal right or obligation
- Education: schooling, teaching, curriculum, examinations, academia
- General: everything else - ordinary prose that fits no domain above

Reply with only the domain name, nothing else.
Sentence: {sent}"""


@query(_EXPECTED_ROUTING)
def routing_table(spark, sf_dir):
    """From the taxonomy's table: claims inverted, then joined with all labels."""
    claims = PRODUCTION.table(spark).select("domain", "ordinal", F.explode(F.concat(F.transform("whole", lambda x: F.struct(x.alias("label"), F.lit(0).alias("partial"))), F.transform("partial", lambda x: F.struct(x.alias("label"), F.lit(1).alias("partial"))))).alias("c"))
    by_label = claims.groupBy("c.label").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "domain"))), lambda x: x["domain"]).alias("who"), F.max("c.partial").alias("shared"))
    labels = spark.createDataFrame([(x,) for x in PRODUCTION.labels], "label string")
    alone = (F.size("who") == 1) & (F.col("shared") == 0)
    outcome = F.when(F.col("who").isNull(), "general").when(alone, "direct").otherwise("ambiguous")
    domain = F.when(F.col("who").isNull(), PRODUCTION.fallback).when(alone, F.get("who", 0))
    return labels.join(by_label, "label", "left").select("label", outcome.alias("outcome"), domain.alias("domain"), F.coalesce(F.array_join("who", "/"), F.lit("")).alias("claimed_by"))


@query(f"SELECT {_quoted(_EXPECTED_PROMPT)} AS prompt")
def prompt_text(spark, sf_dir):
    return spark.createDataFrame([(PRODUCTION.prompt(),)], "prompt string")


def _probe_sql(name: str, probes: dict) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS taxonomy, {_quoted(d)} AS domain, count(*) FILTER (regexp_matches(lower(text), {_quoted('|'.join(k))})) AS hits, round(100.0 * count(*) FILTER (regexp_matches(lower(text), {_quoted('|'.join(k))})) / count(*), 2)::DOUBLE AS share FROM documents" for d, k in probes.items())


@query(_probe_sql("production", PRODUCTION.probes) + " UNION ALL " + _probe_sql("synthetic", SYNTHETIC.probes))
def keyword_probe(spark, sf_dir):
    """All probes in one scan, then unpivoted."""
    docs = table(spark, sf_dir, "documents")
    every = [(name, d, k) for name, t in (("production", PRODUCTION), ("synthetic", SYNTHETIC)) for d, k in t.probes.items()]
    counts = docs.agg(F.count("*").alias("n"), *(F.count_if(contains_any(F.col("text"), k)).alias(f"h{i}") for i, (_, _, k) in enumerate(every)))
    long = counts.select("n", F.explode(F.array(*(F.struct(F.lit(t).alias("taxonomy"), F.lit(d).alias("domain"), F.col(f"h{i}").alias("hits")) for i, (t, d, _) in enumerate(every)))).alias("x"))
    return long.select("x.taxonomy", "x.domain", "x.hits", F.round(100.0 * F.col("x.hits") / F.col("n"), 2).alias("share"))


# ── Corpus ────────────────────────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT conv_id, turn, english, target FROM clean", "clean"))
def clean_text(spark, sf_dir):
    return corpus.clean_pairs(pairs(spark, sf_dir))


@query(f"SELECT doc_id, {_norm('text')} AS text FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", normalize_for_model(F.col("text")).alias("text"))


@query(_sql("SELECT conv_id, turn, english, target FROM (SELECT *, row_number() OVER (PARTITION BY english, target ORDER BY conv_id, turn) AS n FROM clean) WHERE n = 1", "clean"))
def dedupe_pairs(spark, sf_dir):
    return corpus.dedupe_pairs(corpus.clean_pairs(pairs(spark, sf_dir)), [F.col("conv_id"), F.col("turn")])


@query(_sql("SELECT row_id, source_file, english FROM (SELECT *, row_number() OVER (PARTITION BY english ORDER BY row_id) AS n FROM lines) WHERE n = 1", "lines"))
def dedupe_lines(spark, sf_dir):
    return corpus.first_of(lines(spark, sf_dir), ["english"], [F.col("row_id")])


@query("SELECT doc_id::VARCHAR AS id, text AS english, lang, 'documents' AS source_file FROM documents UNION ALL SELECT NULL, text, NULL, 'benchmark' FROM benchmark")
def union_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("english"), "lang")
    return corpus.union_sources({"documents": docs, "benchmark": table(spark, sf_dir, "benchmark").select(F.col("text").alias("english"))})


@query("SELECT * FROM (VALUES ('id', 'c0'), ('english', 'c2'), ('target', 'c1')) AS v(role, \"column\")")
def resolve_columns(spark, sf_dir):
    """role, column: of a frame whose headers say nothing, an id, a German and an English column, gaps included."""
    side = lambda lang: F.when(F.col("lang") == lang, F.col("text"))
    frame = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("r"), "doc_id").alias("c0"), side("de").alias("c1"), side("en").alias("c2"))
    found = layout.resolve_columns(frame, "doc_id")
    return spark.createDataFrame(sorted(found.items()), "role string, column string")


def _sampled_by_lang(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", strip(F.col("text")).alias("value")).where("value <> ''")
    return docs.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id", "value"))).where("n <= 500")


@query(_sql(f"SELECT lang, avg(regexp_matches(value, '{NON_LATIN_PATTERN}')::INT)::DOUBLE AS ratio FROM sample500 GROUP BY lang", "sample500"))
def non_latin_ratio(spark, sf_dir):
    return _sampled_by_lang(spark, sf_dir).groupBy("lang").agg(F.avg(layout.has_non_latin(F.col("value")).cast("double")).alias("ratio"))


@query(_sql(f"SELECT lang, round(avg(list_has_any(regexp_extract_all(lower(value), '{WORD_PATTERN.replace(chr(39), chr(39) * 2)}'), [{', '.join(map(_quoted, ENGLISH_WORDS))}])::INT)::DOUBLE, 9) AS score FROM sample500 GROUP BY lang", "sample500"))
def english_score(spark, sf_dir):
    return _sampled_by_lang(spark, sf_dir).groupBy("lang").agg(F.round(F.avg(layout.has_english_word(F.col("value")).cast("double")), 9).alias("score"))


@query(_sql("SELECT lang, max(length(value)) AS longest, count(*) = count(DISTINCT value) AS is_unique, max(length(value)) <= 32 AND count(*) = count(DISTINCT value) AS looks_like_id FROM sample500 GROUP BY lang", "sample500"))
def id_profile(spark, sf_dir):
    unique = F.count("*") == F.countDistinct("value")
    longest = F.max(F.length("value")).cast("long")
    return _sampled_by_lang(spark, sf_dir).groupBy("lang").agg(longest.alias("longest"), unique.alias("is_unique"), ((longest <= layout.LONGEST_ID) & unique).alias("looks_like_id"))


# ── Seeds ─────────────────────────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT row_id, english FROM seeded", "seeded"))
def seed_random(spark, sf_dir):
    return seeds.random_seeds(lines(spark, sf_dir), SYNTHETIC, "row_id").select("row_id", "english")


@query(_sql(f"SELECT row_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS n FROM routed WHERE route = 'finegrain' AND label IN {_in(SYNTHETIC.ambiguous())}) WHERE n <= 700", "routed"))
def seed_targeted(spark, sf_dir):
    return seeds.targeted_seeds(routed(spark, sf_dir), SYNTHETIC, "row_id").select("row_id", "label")


@query(_sql(f"SELECT DISTINCT text FROM (SELECT {_norm('english')} AS text FROM lines) WHERE text <> '' AND text NOT IN (SELECT {_norm('english')} FROM seeded)", "lines", "seeded"))
def seed_todo_anti(spark, sf_dir):
    own = lines(spark, sf_dir)
    return seeds.todo(own, seeds.random_seeds(own, SYNTHETIC, "row_id").select(F.col("english").alias("text")))


@query(_sql(f"SELECT domain AS label, {_norm('english')} AS text FROM routed WHERE route = 'direct'", "routed"))
def seed_parse(spark, sf_dir):
    """Seed lines written from the settled rows, and read again."""
    own = routed(spark, sf_dir).where("route = 'direct'").select(F.col("domain").alias("label"), F.col("english").alias("text"))
    return seeds.parse_seeds(seeds.seed_lines(own))


@query(_sql("SELECT domain AS label, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM routed WHERE route = 'direct'), 2)::DOUBLE AS share FROM routed WHERE route = 'direct' GROUP BY domain", "routed"))
def seed_distribution(spark, sf_dir):
    return seeds.distribution(seed_parse(spark, sf_dir), "label")


@query(_sql(f"SELECT row_id, answer AS label FROM (SELECT row_id, CASE row_id % 4 WHEN 0 THEN 'Alpha' WHEN 1 THEN 'alpha' WHEN 2 THEN 'Zeta' ELSE 'Nothing' END AS answer FROM lines) WHERE answer IN {_in(SYNTHETIC.names)}", "lines"))
def offtaxonomy_drop(spark, sf_dir):
    """Answers of a teacher that sometimes gives the wrong case or no domain."""
    answer = F.element_at(F.array(*(F.lit(x) for x in ("Alpha", "alpha", "Zeta", "Nothing"))), (F.col("row_id") % 4 + 1).cast("int"))
    return seeds.on_taxonomy(lines(spark, sf_dir).select("row_id", answer.alias("label")), SYNTHETIC)


# ── Gold set ──────────────────────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT row_id, domain FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY md5('7:' || row_id), row_id) AS n FROM routed WHERE domain IS NOT NULL) WHERE n <= 30", "routed"))
def gold_stratified(spark, sf_dir):
    return gold.stratified(routed(spark, sf_dir), "row_id").select("row_id", "domain")


@query(_sql("SELECT row_id, probe, domain FROM missed WHERE n <= 12", "missed"))
def gold_recall(spark, sf_dir):
    return gold.recall(routed(spark, sf_dir), SYNTHETIC_RECALL, "row_id").select("row_id", "probe", "domain")


@query(_sql("SELECT row_id, english, predicted, part, md5('8:' || row_id) AS shuffle FROM gold", "gold"))
def gold_set(spark, sf_dir):
    return gold.gold_set(routed(spark, sf_dir), SYNTHETIC_RECALL, "row_id")


@query(_sql("SELECT row_id, part FROM gold WHERE row_id % 3 <> 0", "gold"))
def gold_todo(spark, sf_dir):
    """A third of the gold set has its labels."""
    rows = stored(gold_set(spark, sf_dir), "gold")
    labelled = rows.where("row_id % 3 = 0").withColumn("domain", F.lit("Alpha"))
    return gold.to_label(rows, labelled).select("row_id", "part")


# ── Metrics ───────────────────────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT doc_id, truth, fold FROM folds", "folds"))
def kfold_assign(spark, sf_dir):
    return metrics.assign_folds(judged(spark, sf_dir), "truth", "doc_id").select("doc_id", "truth", "fold")


def _report_sql(source: str, by: str = "") -> str:
    """Per class figures of ``source``; by: a leading column with a comma, or nothing."""
    return (
        f"SELECT {by}label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, 2 * tp / (support + predicted) AS f1, support::BIGINT AS support, predicted::BIGINT AS predicted "
        f"FROM (SELECT {by}label, sum(t)::DOUBLE AS support, sum(p)::DOUBLE AS predicted, sum(t * hit)::DOUBLE AS tp FROM "
        f"(SELECT {by}truth AS label, 1 AS t, 0 AS p, (truth = pred)::INT AS hit FROM {source} UNION ALL SELECT {by}pred, 0, 1, 0 FROM {source}) GROUP BY {by}label)"
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double"})


def _round_report(by: str, body: str) -> str:
    return f"SELECT {by}label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, predicted FROM ({body})"


def _round_summary(by: str, body: str) -> str:
    group = f" GROUP BY {by.rstrip(', ')}" if by else ""
    return f"SELECT {by}round(sum(recall * support) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(recall * support) / sum(support), 6) AS micro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS rows FROM ({body}){group}"


@query(_sql(_round_report("", _report_sql("judged")), "judged"))
def class_report(spark, sf_dir):
    return _rounded(metrics.class_report(judged(spark, sf_dir)))


@query(_sql(_round_summary("", _report_sql("judged")), "judged"))
def f1_summary(spark, sf_dir):
    return _rounded(metrics.f1_summary(judged(spark, sf_dir)))


@query(_sql(_round_report("part, ", _report_sql("judged", "part, ")), "judged"))
def eval_by_part(spark, sf_dir):
    return _rounded(metrics.class_report(judged(spark, sf_dir), ("part",)))


@query(_sql(_round_summary("fold, ", _report_sql("folds", "fold, ")), "folds"))
def fold_f1(spark, sf_dir):
    return _rounded(metrics.f1_summary(metrics.assign_folds(judged(spark, sf_dir), "truth", "doc_id"), ("fold",)))


_CLASSES = ["good_clean", "good_toxic", "poor_clean", "poor_toxic"]


@query(_sql("SELECT truth, " + ", ".join(f"count(*) FILTER (pred = {_quoted(c)}) AS {c}" for c in _CLASSES) + " FROM judged GROUP BY truth", "judged"))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(judged(spark, sf_dir), _CLASSES)


# ── Student ───────────────────────────────────────────────────────────────────────────────────────────

_NB = """, train AS (SELECT doc_id, part AS label, lower(text) AS text FROM folds WHERE fold <> 0), test AS (SELECT doc_id, lower(text) AS text FROM folds WHERE fold = 0),
counts AS (SELECT label, token, count(*) AS n FROM (SELECT label, unnest(regexp_extract_all(text, '[a-z]+')) AS token FROM train) GROUP BY ALL),
totals AS (SELECT label, sum(n) AS total FROM counts GROUP BY label), vocabulary AS (SELECT count(DISTINCT token) AS v FROM counts),
priors AS (SELECT t.label, ln(count(*)::DOUBLE) AS prior, ln(1.0::DOUBLE / (coalesce(any_value(total), 0) + any_value(v))) AS unseen FROM train t LEFT JOIN totals USING (label) CROSS JOIN vocabulary GROUP BY t.label),
words AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[a-z]+')) AS token FROM test) WHERE token IN (SELECT token FROM counts) GROUP BY ALL),
gains AS (SELECT doc_id, label, sum(w.n * ln(1.0::DOUBLE + c.n)) AS gain FROM words w JOIN counts c USING (token) GROUP BY ALL),
lengths AS (SELECT doc_id, sum(n) AS length FROM words GROUP BY doc_id),
scores AS (SELECT t.doc_id, p.label, p.prior + coalesce(length, 0) * unseen + coalesce(gain, 0) AS s FROM test t CROSS JOIN priors p LEFT JOIN lengths l ON l.doc_id = t.doc_id LEFT JOIN gains g ON g.doc_id = t.doc_id AND g.label = p.label)
SELECT doc_id, min(label) AS predicted FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM scores) WHERE round(s, 9) = round(top, 9) GROUP BY doc_id"""


@query(_sql("", "folds").rstrip() + _NB)
def nb_student(spark, sf_dir):
    """Trained on four folds of the labelled documents to tell their language, applied to the fifth."""
    rows = stored(metrics.assign_folds(judged(spark, sf_dir), "truth", "doc_id"), "folds")
    model = student.NaiveBayes(rows.where("fold <> 0"), label="part")
    return model.predict(rows.where("fold = 0"), "doc_id")


_CV = """, parts AS (SELECT *, part AS y FROM (SELECT *, ((row_number() OVER (PARTITION BY part ORDER BY md5('7:' || doc_id), doc_id) - 1) % 5)::INT AS f FROM judged) WHERE part IN (SELECT part FROM judged GROUP BY part HAVING count(*) >= 5)),
ks AS (SELECT unnest(range(5)) AS k), words AS (SELECT doc_id, f, y, token, count(*) AS n FROM (SELECT doc_id, f, y, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM parts) GROUP BY ALL),
counts AS (SELECT k, y AS label, token, sum(n) AS n FROM words JOIN ks ON f <> k GROUP BY ALL), totals AS (SELECT k, label, sum(n) AS total FROM counts GROUP BY ALL), vocabulary AS (SELECT k, count(DISTINCT token) AS v FROM counts GROUP BY k),
priors AS (SELECT d.k, d.label, ln(d.n::DOUBLE) AS prior, ln(1.0::DOUBLE / (coalesce(total, 0) + v)) AS unseen FROM (SELECT k, y AS label, count(*) AS n FROM parts JOIN ks ON f <> k GROUP BY ALL) d LEFT JOIN totals t ON t.k = d.k AND t.label = d.label JOIN vocabulary v ON v.k = d.k),
known AS (SELECT w.* FROM words w WHERE EXISTS (SELECT 1 FROM counts c WHERE c.k = w.f AND c.token = w.token)),
gains AS (SELECT w.doc_id, c.label, sum(w.n * ln(1.0::DOUBLE + c.n)) AS gain FROM known w JOIN counts c ON c.k = w.f AND c.token = w.token GROUP BY ALL), lengths AS (SELECT doc_id, sum(n) AS length FROM known GROUP BY doc_id),
scores AS (SELECT p.doc_id, p.f, p.y, q.label, q.prior + coalesce(length, 0) * unseen + coalesce(gain, 0) AS s FROM parts p JOIN priors q ON q.k = p.f LEFT JOIN lengths l ON l.doc_id = p.doc_id LEFT JOIN gains g ON g.doc_id = p.doc_id AND g.label = q.label)
SELECT doc_id, f AS fold, y AS truth, min(label) AS pred FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM scores) WHERE round(s, 9) = round(top, 9) GROUP BY ALL"""


@query(_sql("", "judged").rstrip() + _CV)
def student_folds(spark, sf_dir):
    """Each labelled document's language by a naive Bayes that was trained without its fold."""
    rows = judged(spark, sf_dir).select("doc_id", F.col("part").alias("label"), "text")
    return student.cross_validate(rows, "doc_id")


#: Labelled documents of each label that the softmax is trained on, at most; it is applied to all of the fifth fold.
STUDENT_ROWS_PER_LABEL = 1000


def _ml(spark, sf_dir):
    rows = metrics.assign_folds(judged(spark, sf_dir), "truth", "doc_id").select("doc_id", "text", F.col("truth").alias("label"), "fold")
    rows = stored(rows, "folds", ("fold",)).select(*rows.columns)
    others = rows.where("fold <> 0")
    # Ids are drawn before their texts are read, so that no task gets the texts of a label.
    drawn = seeds.sample_per(others.select("label", "doc_id"), "label", STUDENT_ROWS_PER_LABEL, "doc_id").select("doc_id")
    own = seeds.sample_per(others.join(F.broadcast(drawn), "doc_id", "left_semi"), "label", STUDENT_ROWS_PER_LABEL, "doc_id").repartition(spark.sparkContext.defaultParallelism, "doc_id")
    model = student.train(stored(own.select("text", "label"), "sample"))
    return model, rows.where("fold = 0").select("doc_id", "text")


@query()
def ml_student(spark, sf_dir):
    model, rows = _ml(spark, sf_dir)
    return student.ranked(model, rows, "doc_id", 1).select("doc_id", F.get("scores", 0)["label"].alias("predicted"), F.get("scores", 0)["score"].alias("confidence"))


@query()
def stage2_topk(spark, sf_dir):
    model, rows = _ml(spark, sf_dir)
    return student.ranked(model, rows, "doc_id", 3).select("doc_id", F.posexplode("scores").alias("rank", "s")).select("doc_id", "rank", "s.label", "s.score")


# ── Cascade ───────────────────────────────────────────────────────────────────────────────────────────


@query(_sql("SELECT domain, stage, count(*) AS rows FROM classified GROUP BY ALL", "classified"))
def two_stage_union(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("domain", "stage").agg(F.count("*").alias("rows"))


@query(_sql("SELECT row_id, text_norm, label, round(score, 6) AS score, route, domain, stage, round(confidence, 6) AS confidence FROM classified", "classified"))
def predict_contract(spark, sf_dir):
    return classified(spark, sf_dir).select("row_id", "text_norm", "label", F.round("score", 6).alias("score"), "route", "domain", "stage", F.round("confidence", 6).alias("confidence"))


@query(_sql("SELECT row_id, source_file, english, domain FROM classified", "classified"))
def carry_through(spark, sf_dir):
    return classified(spark, sf_dir).select("row_id", "source_file", "english", "domain")


@query(_sql("SELECT coalesce(domain, 'Unclassified') AS domain, count(*) AS rows FROM routed GROUP BY 1", "routed"))
def unclassified_bucket(spark, sf_dir):
    return cascade.or_unclassified(routed(spark, sf_dir)).groupBy("domain").agg(F.count("*").alias("rows"))


# ── Chunks, progress, export ──────────────────────────────────────────────────────────────────────────


def _numbered(spark, sf_dir):
    """The lines with their chunk, not scored."""
    return corpus.with_ordinal(lines(spark, sf_dir), ["row_id"]).withColumn("chunk_id", F.floor(F.col("ordinal") / CHUNK).cast("long"))


def _chunked(spark, sf_dir):
    return route.apply_routing(SCORER.score(_numbered(spark, sf_dir)), SYNTHETIC)


@query(_sql(f"SELECT row_id, ordinal // {CHUNK} AS chunk_id FROM ordered", "ordered"))
def chunk_assign(spark, sf_dir):
    return _numbered(spark, sf_dir).select("row_id", "chunk_id")


@query(_sql(f"SELECT DISTINCT ordinal // {CHUNK} AS chunk_id FROM ordered WHERE (ordinal // {CHUNK}) % 2 = 1", "ordered"))
def chunk_resume_anti(spark, sf_dir):
    """Chunks that aren't done, where those of even number are."""
    every = _numbered(spark, sf_dir).select("chunk_id").distinct()
    return every.join(stored(every.where("chunk_id % 2 = 0"), "manifest"), "chunk_id", "left_anti")


@query(_sql(f"SELECT ordinal // {CHUNK} AS chunk_id, route, count(*) AS rows FROM ordered GROUP BY ALL", "ordered"))
def ckpt_scan(spark, sf_dir):
    """The checkpoint's chunks written, and only two of their columns read."""
    rows = stored(_chunked(spark, sf_dir), "chunks")
    return rows.groupBy("chunk_id", "route").agg(F.count("*").alias("rows"))


@query(_sql(f"SELECT count(*) AS total, count(*) FILTER ((ordinal // {CHUNK}) % 2 = 0) AS done, round(100.0 * count(*) FILTER ((ordinal // {CHUNK}) % 2 = 0) / count(*), 2)::DOUBLE AS percent FROM ordered", "ordered"))
def stage1_progress(spark, sf_dir):
    """Rows of the finished chunks against an exact count of the source."""
    done = F.count_if(F.col("chunk_id") % 2 == 0)
    return _numbered(spark, sf_dir).agg(F.count("*").alias("total"), done.alias("done"), F.round(100.0 * done / F.count("*"), 2).alias("percent"))


@query(_sql(f"SELECT domain, part, (part - 1) * {PART} + 1 AS first_row, least(part * {PART}, n) AS last_row, least(part * {PART}, n) - (part - 1) * {PART} AS rows FROM (SELECT domain, n, unnest(range(1, (n + {PART} - 1) // {PART} + 1)) AS part FROM (SELECT domain, count(*) AS n FROM routed WHERE domain IS NOT NULL GROUP BY domain))", "routed"))
def export_parts(spark, sf_dir):
    return export.part_list(routed(spark, sf_dir), "domain", PART)


@query(_sql(f"SELECT row_id, domain, (row_number() OVER (PARTITION BY domain ORDER BY row_id) - 1) // {PART} + 1 AS part FROM routed WHERE domain IS NOT NULL", "routed"))
def export_part_rows(spark, sf_dir):
    return export.parts(routed(spark, sf_dir), "domain", ["row_id"], PART).select("row_id", "domain", "part")


@query(_sql(f"SELECT ordinal // {CHUNK} + 1 AS chunk, domain, count(*) AS rows FROM ordered WHERE domain IS NOT NULL GROUP BY ALL", "ordered"))
def corpus_chunk_histogram(spark, sf_dir):
    return _chunked(spark, sf_dir).where("domain is not null").groupBy((F.col("chunk_id") + 1).alias("chunk"), "domain").agg(F.count("*").alias("rows"))


@query(_sql("SELECT lower(domain) || '.csv' AS file, count(*) AS rows FROM classified WHERE domain IS NOT NULL GROUP BY 1", "classified"))
def domain_split_counts(spark, sf_dir):
    return classified(spark, sf_dir).where("domain is not null").groupBy(F.concat(F.lower("domain"), F.lit(".csv")).alias("file")).agg(F.count("*").alias("rows"))


@query(_sql(f"SELECT domain, count(*) AS pairs, round(100.0 * count(*) / (SELECT count(*) FROM routed), 2)::DOUBLE AS share, lower(domain) || '.csv' AS csv, (count(*) + {PART} - 1) // {PART} AS parts FROM routed WHERE domain IS NOT NULL GROUP BY domain", "routed"))
def domain_summary(spark, sf_dir):
    return export.domain_summary(routed(spark, sf_dir), PART)


@query(
    _sql(
        "SELECT 'run' AS section, 'rows' AS item, count(*)::VARCHAR AS value FROM routed UNION ALL SELECT 'source', 'files', count(DISTINCT source_file)::VARCHAR FROM routed "
        "UNION ALL SELECT 'stage 1', 'mean score', printf('%.4f', round(avg(score), 4)) FROM routed UNION ALL SELECT 'rows per file', source_file, count(*)::VARCHAR FROM routed GROUP BY source_file "
        "UNION ALL SELECT 'routing', route, count(*) || ' (' || printf('%.1f', round(100.0 * count(*) / (SELECT count(*) FROM routed), 1)::DOUBLE) || '%)' FROM routed GROUP BY route "
        "UNION ALL SELECT 'domain distribution', domain, count(*) || ' (' || printf('%.2f', round(100.0 * count(*) / (SELECT count(*) FROM routed), 2)::DOUBLE) || '%)' FROM routed WHERE domain IS NOT NULL GROUP BY domain "
        "UNION ALL SELECT 'settings', 'threshold', '0.6'",
        "routed",
    )
)
def run_metadata(spark, sf_dir):
    return export.run_metadata(routed(spark, sf_dir), {"threshold": str(route.THRESHOLD)})


@query(_sql("SELECT row_id, domain, substring(english, 1, 70) AS preview FROM routed ORDER BY row_id LIMIT 100", "routed"))
def prediction_preview(spark, sf_dir):
    return export.preview(routed(spark, sf_dir), ["row_id"], "english").select("row_id", "domain", "preview")


@query(_sql("SELECT bucket, count(*) AS rows, sum(size)::BIGINT AS chars, sum(bucket * 32 - size)::BIGINT AS padding FROM (SELECT length(coalesce(english, '')) AS size, CASE WHEN length(coalesce(english, '')) = 0 THEN 0 ELSE (length(english) - 1) // 32 + 1 END AS bucket FROM lines) GROUP BY bucket", "lines"))
def length_buckets(spark, sf_dir):
    return export.length_buckets(lines(spark, sf_dir), "english")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
