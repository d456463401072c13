"""Registered queries over the given tables, one per operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeResult

from corpuscope.config import (
    CHUNK_SIZE,
    DEFAULT_EXTENSIONS,
    EVAL_TOP_K,
    TEST_COLLECTION,
    EngineConfig,
)
from corpuscope.functions.parsing import with_parsed
from corpuscope.functions.text import WHITESPACE, unix_newlines
from corpuscope.operators import (
    answers,
    chunks,
    coarse,
    dictionary,
    evaluation,
    latent,
    lineage,
    postings,
    terms,
    workflows,
)
from corpuscope.operators.nearest import (
    nearest,
    nearest_approximate,
    nearest_diverse,
    recall,
)
from corpuscope.operators.nearest import question_warnings as find_warnings
from corpuscope.plans import corpora
from corpuscope.plans.ask import question_vectors
from corpuscope.plans.index import update_collection, write_collection
from corpuscope.plans.ingest import (
    FALLBACK,
    default_processors,
    documents,
    ingest,
    ingest_warnings,
    with_extension,
)
from corpuscope.session import materialize, scratch_path
from corpuscope.sources.collections import open_collection


def _only(suffix: str) -> dict:
    """Processor of one extension, for a repository that holds nothing else."""
    return {suffix: default_processors()[suffix]}


def _rows_of(files: DataFrame, kind: str, suffix: str) -> DataFrame:
    rows = ingest(files, processors=_only(suffix), kinds=(kind,))
    return rows.where(F.col("kind") == kind)


# --- ingest ------------------------------------------------------------------
def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest(corpora.text_files(spark, sf_dir)).where(F.col("kind") == "raw")
    return rows.select("source", "doc_id", "page_content")


def ext_dispatch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = with_extension(corpora.text_files(spark, sf_dir), DEFAULT_EXTENSIONS)
    return files.groupBy("ext").agg(
        F.count("*").alias("n_files"), F.sum(F.char_length("content")).alias("n_chars")
    )


def dag_summary_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.workflow_files(spark, sf_dir), "dag_summary", ".yaml")
    return rows.select(
        "source", "ordinal", "doc_id", "page_content", "dag_id", "owner", "schedule",
        "dag_description",
    )


def dag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = with_extension(corpora.workflow_files(spark, sf_dir), (".yaml",))
    parsed = with_parsed(files, {".yaml": workflows.PARSER}, keep=("path",))
    return workflows.edge_rows(parsed, F.col("parsed.p0"))


def dag_task_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.workflow_files(spark, sf_dir), "dag_task", ".yaml")
    return rows.select(
        "source", "ordinal", "doc_id", "page_content", "task_name", "operator", "script_file",
        "owner",
    )


def dag_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forks, joins, defaults, nulls and executions that are no list."""
    files = corpora.workflow_shape_files(spark, sf_dir)
    rows = ingest(files, processors=_only(".yaml"), kinds=("dag_summary", "dag_task"))
    return rows.select("source", "ordinal", "kind", "doc_id", "page_content")


def dag_by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which workflows run on the schedule '0 5 * * 1'?"""
    rows = _rows_of(corpora.workflow_files(spark, sf_dir), "dag_summary", ".yaml")
    return rows.where(F.col("schedule") == "0 5 * * 1").select("dag_id", "owner")


def dag_fault_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = corpora.faulty_workflow_files(spark, sf_dir)
    rows = documents(ingest(files, processors=_only(".yaml"), fields=("doc_id",)))
    return rows.select("source", "ordinal", "kind", "doc_id")


def file_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = corpora.faulty_workflow_files(spark, sf_dir).unionByName(
        corpora.python_files(spark, sf_dir)
    )
    return ingest_warnings(ingest(files, processors=_only(".yaml") | _only(".py"), kinds=())).select(
        "path", "class"
    )


class SettingsSections:
    """An own processor: the sections of a file of settings, and what they set."""

    @staticmethod
    def analyze(path, content) -> AnalyzeResult:
        fields = ("kind", "doc_id", "page_content")
        return AnalyzeResult(T.StructType([T.StructField(f, T.StringType()) for f in fields]))

    def eval(self, path, content):
        name, keys = None, []
        for line in [*content.split("\n"), "[]"]:
            if line.startswith("["):
                if name is not None:
                    yield "section", name, f"Section '{name}' sets {', '.join(keys)}."
                name, keys = line.strip("[]"), []
            elif line.strip() and not line.startswith(";"):
                key, mark, _ = line.partition("=")
                if not mark:
                    raise ValueError(f"no value: {line}")
                keys.append(key.strip())


def table_function_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an extension that only a table function knows."""
    config = EngineConfig(extensions=(".ini",))
    rows = ingest(corpora.settings_files(spark, sf_dir), config, {".ini": SettingsSections})
    return rows.select("source", "ordinal", "kind", "doc_id", "content_type", "page_content")


def nested_file_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and warnings of files whose aliases or brackets may not fit the budget."""
    rows = ingest(corpora.nested_files(spark, sf_dir), processors=_only(".yaml"))
    return rows.select("source", "ordinal", "kind", "doc_id", "content_type")


def dictionary_table_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.dictionary_files(spark, sf_dir), "table", ".json")
    return rows.select("source", "ordinal", "page_content", "schema", "table", "table_description")


def dictionary_column_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.dictionary_files(spark, sf_dir), "column", ".json")
    return rows.select("source", "ordinal", "page_content", "schema", "table", "column")


def dictionary_rich_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = with_extension(corpora.dictionary_files(spark, sf_dir), (".json",))
    parsed = with_parsed(files, {".json": dictionary.PARSER})
    docs = F.explode(dictionary.derived_documents(F.col("parsed.p0"), rich=True)).alias("d")
    return parsed.select(F.col("path").alias("source"), docs).select(
        "source", "d.kind", "d.table", "d.column", "d.page_content"
    )


def sql_main_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = lineage.clean_script(unix_newlines(F.col("content")))
    return corpora.sql_files(spark, sf_dir).select(
        "path", lineage.main_query(script).alias("main_query")
    )


def sql_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.sql_files(spark, sf_dir), "sql_summary", ".sql")
    return rows.select("source", "page_content", "content_type")


def sql_lineage_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.sql_shape_files(spark, sf_dir), "sql_summary", ".sql")
    return rows.select("source", "page_content")


def sql_table_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which scripts read from a table? Counted per table over all scripts."""
    script = lineage.clean_script(unix_newlines(F.col("content")))
    reads = corpora.sql_files(spark, sf_dir).select(
        F.posexplode(lineage.tables(lineage.main_query(script))).alias("position", "table_name")
    )
    return reads.groupBy("table_name").agg(
        F.count("*").alias("n_scripts"), F.sum("position").alias("sum_position")
    )


def python_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.python_files(spark, sf_dir), "python_summary", ".py")
    return rows.select("source", "page_content", "content_type")


def python_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows_of(corpora.python_files(spark, sf_dir), "function", ".py")
    return rows.select("source", "ordinal", "page_content", "function_name")


def _structured_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = corpora.stored_orders(spark, sf_dir)
    parts = (corpora.dictionary_files, corpora.sql_files, corpora.python_files)
    return reduce(
        DataFrame.unionByName,
        [part(spark, sf_dir) for part in parts],
        corpora.workflow_files(spark, sf_dir, orders).unionByName(
            corpora.faulty_workflow_files(spark, sf_dir, orders)
        ),
    )


def union_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(ingest(_structured_files(spark, sf_dir)))
    return rows.groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count("doc_id").alias("n_doc_ids")
    )


# --- chunks ------------------------------------------------------------------
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace("text", r"[ \t\r\n]+", "")
    return corpora.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(chunks.windows(text)).alias("chunk_no", "chunk")
    )


def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = corpora.spread_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/text/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        F.col("text").alias("content"),
    )
    rows = documents(ingest(files, processors=_only(FALLBACK)))
    return rows.select("source", "ordinal", "page_content")


def chunk_recursive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of chunk_recursive by built-in functions only."""
    text = unix_newlines(F.coalesce(F.col("text"), F.lit("")))
    return corpora.spread_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/text/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("source"),
        F.posexplode(chunks.recursive(text)).alias("ordinal", "page_content"),
    )


def chunk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks without overlap, joined again, are the whole text but for blanks."""
    files = corpora.spread_table(spark, sf_dir, "documents").select(
        "doc_id", F.lit("text").alias("ext"), F.col("text").alias("content")
    )
    parsed = with_parsed(files, {"text": chunks.parser(overlap=0)})
    pieces = F.col("parsed.p0")
    return parsed.select(
        "doc_id",
        F.md5(F.regexp_replace(F.array_join(pieces, ""), f"[{WHITESPACE}]+", "")).alias("digest"),
        F.forall(pieces, lambda c: F.char_length(c) <= CHUNK_SIZE).alias("all_fit"),
    )


# --- term retrieval ----------------------------------------------------------
def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.spread_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "source", F.col("text").alias("page_content")
    )


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    vectors = terms.vectors(docs, terms.fit(docs))
    pairs = vectors.select("row_id", F.explode(F.arrays_zip("terms", "weights")).alias("p"))
    return pairs.select(
        F.col("row_id").alias("doc_id"),
        F.col("p.terms").alias("term"),
        F.round("p.weights", 6).alias("weight"),
    )


def _text_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    vocabulary = terms.fit(docs)
    asked = question_vectors(_questions(spark, sf_dir), vocabulary)
    return nearest(asked, terms.vectors(docs, vocabulary), EVAL_TOP_K, "terms")


def text_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_results(spark, sf_dir)


def text_topk_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of text_topk from stored postings: only the questions' terms are read."""
    docs = _documents(spark, sf_dir)
    vocabulary = terms.fit(docs)
    vectors = terms.vectors(docs, vocabulary, tasks=postings.tasks_for(vocabulary.n_pairs))
    blocks = postings.store(vectors, scratch_path(spark, "postings"), gathered=True)
    asked = question_vectors(_questions(spark, sf_dir), vocabulary)
    return postings.nearest_posted(blocks, asked, EVAL_TOP_K)


def answer_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = answers.assemble(_text_results(spark, sf_dir), _documents(spark, sf_dir))
    return answered.select(
        "query_id", "n_rows", "context", F.array_join("sources", ", ").alias("sources")
    )


# --- vector retrieval --------------------------------------------------------
def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.spread_table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "row_id")


def _embedded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "query_id")


def vector_topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_embedded_questions(spark, sf_dir), _embeddings(spark, sf_dir), EVAL_TOP_K)


def vector_topk_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(
        _embedded_questions(spark, sf_dir), _embeddings(spark, sf_dir), EVAL_TOP_K, "l2"
    )


def vector_topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for question sets too large to send to every task: questions and rows of
    one table, in several cuts of both."""
    config = EngineConfig(broadcast_bytes=0, cell_bytes=128 << 10)
    vectors = corpora.table(spark, sf_dir, "embeddings")
    return nearest(
        vectors.withColumnRenamed("vec_id", "query_id"),
        vectors.withColumnRenamed("vec_id", "row_id"),
        EVAL_TOP_K, "cosine", config,
    )


def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question has a metadata filter and a limit of its own."""
    label = F.col("label").cast("string")
    following = ((F.col("label") + 1) % 10).cast("string")
    same = F.concat(F.lit('{"eq": ["label", '), label, F.lit("]}"))
    either = F.concat(
        F.lit('{"or": [{"in": ["label", ['), label, F.lit(", "), following,
        F.lit(']]}, {"lt": ["label", 2]}]}'),
    )
    questions = _embedded_questions(spark, sf_dir).select(
        "query_id", "embedding",
        F.when(F.col("query_id") % 2 == 0, same).otherwise(either).alias("filter"),
        (1 + F.col("query_id") % 7).cast("int").alias("limit"),
    )
    return nearest(questions, _embeddings(spark, sf_dir), EVAL_TOP_K)


def question_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters of all kinds, most of which cannot be used."""
    key = F.col("query_id") % 6
    spec = (
        F.when(key == 0, F.lit('{"eq": ["label", 3]}'))
        .when(key == 1, F.lit('{"eq": ["label"'))
        .when(key == 2, F.lit('{"near": ["label", 1]}'))
        .when(key == 3, F.lit('{"and": [{"lt": ["label", 3]}, {"eq": ["owner", 1]}]}'))
        .when(key == 4, F.lit('{"in": ["label", [1, "x"]]}'))
    )
    questions = _embedded_questions(spark, sf_dir).withColumn("filter", spec)
    return find_warnings(questions, _embeddings(spark, sf_dir))


def answer_all_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for each question, though some filters match nothing or are malformed."""
    key = F.col("query_id") % 4
    same = F.concat(F.lit('{"eq": ["label", '), F.col("label").cast("string"), F.lit("]}"))
    spec = (
        F.when(key == 0, same)
        .when(key == 1, F.lit('{"eq": ["label", 99]}'))
        .when(key == 2, F.lit('{"eq": "label"}'))
    )
    questions = _embedded_questions(spark, sf_dir).select(
        "query_id", "embedding", spec.alias("filter"),
        (1 + F.col("query_id") % 7).cast("int").alias("limit"),
    )
    rows = _embeddings(spark, sf_dir)
    texts = rows.select(
        "row_id",
        F.concat(F.lit("label "), "label").alias("source"),
        F.concat(F.lit("vector "), "row_id").alias("page_content"),
    )
    answered = answers.assemble(nearest(questions, rows, EVAL_TOP_K), texts, questions=questions)
    return answered.select(
        "query_id", "n_rows", "context", F.array_join("sources", ", ").alias("sources")
    )


def vector_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_diverse(_embedded_questions(spark, sf_dir), _embeddings(spark, sf_dir), k=8)


def vector_lsh_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, rows = _embedded_questions(spark, sf_dir), _embeddings(spark, sf_dir)
    return recall(
        nearest_approximate(questions, rows, EVAL_TOP_K, "l2"),
        nearest(questions, rows, EVAL_TOP_K, "l2"),
    )


def _coarse(spark: SparkSession, sf_dir: str, probes: int, kind: str = "cosine") -> DataFrame:
    rows = corpora.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "row_id")
    index = coarse.store(rows, scratch_path(spark, "coarse"), coarse.Cells(cells=32))
    return coarse.nearest_stored(
        index, _embedded_questions(spark, sf_dir), EVAL_TOP_K, kind, probes
    )


def vector_cells_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index with all cells probed: exact."""
    return _coarse(spark, sf_dir, 32)


def vector_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some cells probed, against the exact result: at least 0.9 is found.

    The given vectors are nearly without direction, so many cells are needed.
    """
    found = recall(_coarse(spark, sf_dir, 20), vector_topk_cosine(spark, sf_dir))
    return found.select("n_expected", (F.col("recall") >= 0.9).alias("enough"))


def latent_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names by dense vectors of the corpus's own. The names have fewer words than the
    vectors have columns, so similarities are those of the term weights."""
    docs = corpora.spread_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_name").alias("page_content")
    )
    vocabulary, model = latent.fit_documents(docs, rank=32)
    embedded = latent.embed(terms.vectors(docs, vocabulary), model)
    rows = materialize(embedded.select("row_id", "embedding"))
    asked = rows.where(F.col("row_id") % 20 == 0).withColumnRenamed("row_id", "query_id")
    return nearest(asked, rows, 40)


# --- evaluation --------------------------------------------------------------
def retrieval_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit rate and MRR over all embeddings; a row is right if it has the label
    of the question. The question's own row is left out."""
    questions, rows = _embedded_questions(spark, sf_dir), _embeddings(spark, sf_dir)
    ranked = nearest(questions, rows, EVAL_TOP_K + 1).where(F.col("row_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy("rank")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= EVAL_TOP_K
    )
    labelled = ranked.join(rows.select("row_id", F.col("label").alias("row_label")), "row_id")
    marked = questions.select("query_id", "label").join(labelled, "query_id", "left").select(
        "query_id", "rank", F.coalesce(F.col("label") == F.col("row_label"), F.lit(False)).alias("hit")
    )
    return evaluation.summary(evaluation.per_question(marked))


def _golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("query_id")
    expected = F.when(key % 3 == 0, F.array(key, key + 1)).otherwise(F.array(key))
    return _embedded_questions(spark, sf_dir).select("query_id", expected.alias("expected_ids"))


def retrieval_must_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = vector_topk_cosine(spark, sf_dir)
    return evaluation.containment(results, _golden(spark, sf_dir), "row_id")


def retrieval_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reciprocal rank per question against lists of expected rows."""
    results = vector_topk_cosine(spark, sf_dir)
    return evaluation.per_question(
        evaluation.mark_expected(results, _golden(spark, sf_dir), "row_id")
    )


# --- index -------------------------------------------------------------------
def index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store two collections, read one back."""
    root = scratch_path(spark, "index")
    write_collection(ingest(corpora.python_files(spark, sf_dir)), root)
    write_collection(
        ingest(
            corpora.sql_files(spark, sf_dir).unionByName(corpora.dictionary_files(spark, sf_dir))
        ),
        root,
        EngineConfig(collection=TEST_COLLECTION),
    )
    stored = open_collection(spark, root, TEST_COLLECTION)
    has_terms = F.size("terms") > 0
    vectors = stored.vectors.groupBy("kind").agg(F.count_if(has_terms).alias("n_vectors"))
    return (
        stored.documents.groupBy("kind")
        .agg(F.count("*").alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))
        .join(vectors, "kind")
    )


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived documents as a stored collection gives them back, each with its vector."""
    root = scratch_path(spark, "rows")
    files = corpora.sql_files(spark, sf_dir).unionByName(corpora.dictionary_files(spark, sf_dir))
    write_collection(ingest(files), root)
    stored = open_collection(spark, root, EngineConfig().collection)
    norm = F.aggregate("weights", F.lit(0.0), lambda total, w: total + w * w)
    vectors = stored.vectors.select("row_id", F.round(norm, 6).alias("norm"))
    rows = stored.documents.where(F.col("kind").isin("table", "column", "sql_summary"))
    return rows.join(vectors, "row_id").select("source", "ordinal", "kind", "page_content", "norm")


def index_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index scripts, alter a tenth, take a tenth away, index again what changed."""
    files = corpora.python_files(spark, sf_dir)
    key = F.regexp_extract("path", r"(\d+)\.py", 1).cast("long")
    other = F.concat(F.lit("import altered_"), key.cast("string"), F.lit("\n"))
    altered = files.where(key % 10 != 4).withColumn(
        "content", F.when(key % 10 == 3, other).otherwise(F.col("content"))
    )
    root = scratch_path(spark, "update")
    update_collection(files, root)
    update_collection(altered, root)
    stored = open_collection(spark, root, EngineConfig().collection)
    vectors = stored.vectors.select("row_id", F.size("terms").alias("n_terms"))
    rows = stored.documents.where(F.col("kind") == "python_summary")
    return rows.join(vectors, "row_id").select("source", "ordinal", "page_content", "n_terms")


QUERIES = {
    f.__name__: f
    for f in (
        raw_documents,
        ext_dispatch_counts,
        dag_summary_docs,
        dag_edges,
        dag_task_docs,
        dag_shapes,
        dag_by_schedule,
        dag_fault_prefix,
        file_warnings,
        nested_file_docs,
        table_function_docs,
        dictionary_table_docs,
        dictionary_column_docs,
        dictionary_rich_docs,
        sql_main_query,
        sql_lineage,
        sql_lineage_shapes,
        sql_table_readers,
        python_imports,
        python_functions,
        union_hybrid,
        chunk_windows,
        chunk_recursive,
        chunk_recursive_columns,
        chunk_coverage,
        tfidf_weights,
        text_topk,
        text_topk_postings,
        answer_context,
        vector_topk_cosine,
        vector_topk_l2,
        vector_topk_cells,
        vector_topk_filtered,
        question_warnings,
        answer_all_questions,
        vector_mmr,
        vector_lsh_recall,
        vector_cells_all,
        vector_cells_recall,
        latent_topk,
        retrieval_eval,
        retrieval_must_find,
        retrieval_golden,
        index_roundtrip,
        index_rows,
        index_update,
    )
}
