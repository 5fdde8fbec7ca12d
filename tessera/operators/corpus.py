"""Entities of a text corpus, as projections and explodes of landed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import permissive
from tessera.functions.repair import as_list, json_object, kind_from_name

#: Natural keys.
ENTITY_KEYS = {
    "chunks": ("video_id", "chunk_index"),
    "chunks_contextual": ("video_id", "chunk_index"),
    "transcripts": ("video_id",),
    "segments": ("video_id", "segment_index"),
    "summaries": ("video_id",),
    "golden_qa": ("case_id",),
    "golden_answers": ("question_id",),
    "eval_runs": ("run_id",),
    "graph_entities": ("chunk_sha", "name"),
    "graph_relations": ("chunk_sha", "source", "target", "relation_type"),
    "graph_claims": ("chunk_sha", "claim_index"),
    "themes": ("theme_id",),
}


def text_sha(c: Column) -> Column:
    return F.substring(F.sha2(F.coalesce(c, F.lit("")), 256), 1, 16)


def embedding_text(header: Column, text: Column) -> Column:
    """Header and text on two lines; the bare text without a header."""
    return F.when(F.coalesce(header, F.lit("")) != "", F.concat(header, F.lit("\n"), text)).otherwise(text)


def chunk_rows(records: DataFrame) -> DataFrame:
    """Chunks from (video_id, chunk_index, context_header, title, text). The hash covers what is embedded, header and all."""
    body = embedding_text(F.col("context_header"), F.col("text"))
    return records.select(
        F.concat_ws(":", "video_id", F.col("chunk_index").cast("string")).alias("chunk_key"), "video_id", F.col("chunk_index").cast("int").alias("chunk_index"),
        F.coalesce("title", F.lit("")).alias("title"), "text", body.alias("embedding_text"), text_sha(body).alias("text_sha"),
    )


_BODY = "description string, tags array<string>, transcript_languages array<string>, segments array<struct<text:string,offset_ms:bigint,start_seconds:double>>"


def transcript_rows(records: DataFrame) -> DataFrame:
    """Transcripts from (video_id, document, description): the description in the body wins."""
    body = json_object(F.col("document"), _BODY)
    return records.withColumn("_b", body).select(
        "video_id", F.coalesce(F.nullif(F.col("_b.description"), F.lit("")), F.col("description"), F.lit("")).alias("description"),
        as_list(F.col("_b.tags")).alias("tags"), as_list(F.col("_b.transcript_languages")).alias("languages"), F.coalesce(F.size("_b.segments"), F.lit(0)).alias("n_segments"),
    )


def segment_rows(records: DataFrame) -> DataFrame:
    """One row per segment with its place in the list; items that are no objects are skipped but keep their number."""
    body = json_object(F.col("document"), "segments array<string>")
    one = records.select("video_id", F.posexplode(body["segments"]).alias("segment_index", "_s")).where(F.trim("_s").startswith("{"))
    seg = F.from_json("_s", "text string, offset_ms bigint, start_seconds double")
    return one.withColumn("_p", seg).select("video_id", "segment_index", F.coalesce("_p.text", F.lit("")).alias("text"), F.col("_p.offset_ms").alias("offset_ms"), F.col("_p.start_seconds").alias("start_seconds"))


def summary_rows(records: DataFrame) -> DataFrame:
    return records.select("video_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("summary", F.lit("")).alias("summary"), text_sha(F.col("summary")).alias("text_sha"))


def golden_rows(payloads: DataFrame) -> DataFrame:
    """Golden questions from (payload): one row per entry."""
    ddl = "corpus struct<verified_at:string>, entries array<struct<id:string,question:string,reference_answer:string,expected_video_ids:array<string>,expected_chunk_ids:array<string>,domain:string>>"
    one = payloads.select(F.from_json("payload", ddl).alias("p")).select("p.corpus.verified_at", F.explode("p.entries").alias("e"))
    return one.select(
        F.col("e.id").alias("case_id"), "e.question", F.coalesce("e.reference_answer", F.lit("")).alias("reference_answer"), as_list(F.col("e.expected_video_ids")).alias("expected_video_ids"),
        as_list(F.col("e.expected_chunk_ids")).alias("expected_chunk_ids"), F.coalesce("e.domain", F.lit("general")).alias("domain"), F.lit("unanchored").alias("anchor_status"), "verified_at",
    )


METRICS = ("groundedness", "relevance", "insight", "specificity", "coverage", "breadth", "calibration", "composite")


def golden_answer_rows(records: DataFrame) -> DataFrame:
    """Answers from (question_id, answer, scores map, chunk_keys, hops): scores flattened, NULL scores stay NULL, counters default to 0."""
    scores = [F.try_element_at("scores", F.lit(m)).alias(m) for m in METRICS]
    return records.select("question_id", F.coalesce("answer", F.lit("")).alias("answer"), *scores, F.to_json(as_list(F.col("chunk_keys"))).alias("chunk_keys_json"), F.coalesce("hops", F.lit(0)).alias("hops"))


def eval_run_rows(records: DataFrame) -> DataFrame:
    """Runs from (file_name, run_id, payload map<string,string>): the payload as JSON with sorted keys."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries("payload")))
    return records.select("run_id", kind_from_name(F.col("file_name")).alias("kind"), "file_name", F.to_json(ordered).alias("payload_json"))


def theme_rows(payloads: DataFrame) -> DataFrame:
    """Themes from (payload): {"themes": [...]} or the bare list."""
    item = "array<struct<id:string,label:string,chunk_keys:array<string>>>"
    listed = F.coalesce(F.from_json(F.when(F.trim("payload").startswith("{"), F.col("payload")), f"themes {item}")["themes"], F.from_json(F.when(F.trim("payload").startswith("["), F.col("payload")), item))
    return payloads.select(F.explode(listed).alias("t")).select(F.col("t.id").alias("theme_id"), F.coalesce("t.label", F.lit("")).alias("label"), F.to_json(as_list(F.col("t.chunk_keys"))).alias("chunk_keys_json"))


_GRAPH = "entities array<struct<name:string,type:string,aliases:array<string>>>, relations array<struct<source:string,target:string,type:string,weight:double>>, claims array<struct<text:string,polarity:string,subject:string,entity:string>>"


def graph_rows(extractions: DataFrame) -> dict[str, DataFrame]:
    """Entities, relations and claims from (chunk_sha, extraction)."""
    g = extractions.select("chunk_sha", json_object(F.col("extraction"), _GRAPH).alias("g"))
    entity = g.select("chunk_sha", F.explode("g.entities").alias("e")).select("chunk_sha", "e.name", F.coalesce("e.type", F.lit("")).alias("entity_type"), as_list(F.col("e.aliases")).alias("aliases"))
    relation = g.select("chunk_sha", F.explode("g.relations").alias("r")).select("chunk_sha", "r.source", "r.target", F.coalesce("r.type", F.lit("")).alias("relation_type"), "r.weight")
    claim = g.select("chunk_sha", F.posexplode("g.claims").alias("claim_index", "c"))
    claim = claim.select("chunk_sha", "claim_index", "c.text", "c.polarity", F.coalesce(F.nullif(F.col("c.subject"), F.lit("")), F.col("c.entity"), F.lit("")).alias("subject"))
    return {"graph_entities": entity, "graph_relations": relation, "graph_claims": claim}


def frame_sha(df: DataFrame) -> DataFrame:
    """One row: sha, a hash of the frame's rows in any order and columns in any order; ``empty000`` without rows.

    Four 32-bit parts of the row digests are summed rather than listed, so nothing is gathered
    in one task; equal rows count as often as they occur.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(F.col("d"), 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(4)]
    total = df.select(digest.alias("d")).agg(F.count("*").alias("n"), *parts)
    joined = F.sha2(F.concat_ws("|", "n", "s0", "s1", "s2", "s3"), 256)
    return total.select(F.when(F.col("n") == 0, "empty000").otherwise(F.substring(joined, 1, 8)).alias("sha"))


#: The fields of a judged answer, as (column, path below the record), by how they are read.
ANSWER_FIELDS = {
    "key": [("question_id", "question_id"), ("category", "category"), ("domain", "domain"), ("question", "question")],
    "text": [
        ("source_case_id", "source_case_id"), ("answer_md", "answer"), ("answer_model", "answer_model"), ("terminated_reason", "terminated_reason"), ("judge_model", "judge_model"),
        ("rubric_version", "rubric_version"), ("judge_error", "judge_error"), ("captured_at", "captured_at"),
    ],
    "list": [("contexts_json", "contexts"), ("references_json", "references"), ("chunk_ids_json", "chunk_ids"), ("queries_json", "queries")],
    "count": [("iterations", "iterations"), ("llm_calls", "llm_calls")],
    "score": [
        *[(m, f"scores.{m}") for m in ("faithfulness", "answer_relevancy", "context_precision", "insight_depth", "specificity", "coverage", "evidence_breadth", "calibration")],
        ("ragas_v1_composite", "ragas_v1_composite"), ("composite", "composite"),
    ],
    "flag": [("cap_applied", "cap_applied"), ("grounding_floor_breached", "grounding_floor_breached")],
}


def golden_answer_table(records: DataFrame, source: str, column: str = "record") -> DataFrame:
    """All fields of judged answers from their JSON text: scores flattened and NULL where missing, lists as JSON, counters 0, texts empty. Text that is no object gives no row."""
    read = {
        "key": permissive.as_text, "text": lambda v, p: permissive.as_text(v, p, ""), "list": permissive.as_json_list, "count": lambda v, p: permissive.as_int(v, p, 0),
        "score": permissive.as_float, "flag": permissive.as_flag,
    }
    v = records.select(permissive.as_object(F.col(column)).alias("v")).where("v IS NOT NULL")
    return v.select(*[read[how](F.col("v"), f"$.{path}").alias(name) for how, fields in ANSWER_FIELDS.items() for name, path in fields], F.lit(source).alias("source"))


def eval_run_table(runs: DataFrame) -> DataFrame:
    """Runs from (file_name, payload): run_id, source_file, kind, created_at, entry_count and the payload as JSON with sorted keys, nested ones too.

    What the payload lacks comes from the file's name; a payload that is no object is an empty one.
    """
    v = runs.select("file_name", F.coalesce(permissive.as_object(F.col("payload")), F.parse_json(F.lit("{}"))).alias("v"))
    text = lambda p: permissive.as_text(F.col("v"), f"$.{p}")
    n = lambda p: permissive.as_int(F.col("v"), f"$.{p}")
    return v.select(
        F.coalesce(text("run_id"), "file_name").alias("run_id"), F.col("file_name").alias("source_file"), F.coalesce(text("kind"), kind_from_name(F.col("file_name"))).alias("kind"),
        text("created_at").alias("created_at"), F.coalesce(F.nullif(n("entry_count"), F.lit(0).cast("bigint")), n("entries")).alias("entry_count"), permissive.sorted_json(F.col("v")).alias("payload_json"),
    )
