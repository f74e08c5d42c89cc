"""The registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbmart.llm import bpe, collocations, html, langid, minhash, mixing, ngramlm, nndescent, packing, rules, spelling, urls, vecgraph
from plumbmart.llm.common import fold, stored, table
from plumbmart.llm.sql import SQL  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_decode(docs, bpe.Model(tokenizer_path()), packed=True)
    return done.select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: Rules of the URL filter: verdict, host, path.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between all embeddings of equal label with a cosine of 0.93 or more, and the components they form."""
    return vecgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned from those outside fold 2 of 7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = ngramlm.score(docs, fold("doc_id", 7) != 2)
    return done.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text")
    stats = stored(rules.statistics(docs).drop("text"), "statistics")
    model = rules.train(stats.where("not held_out"), table(spark, sf_dir, "labels"))
    return rules.score(stats, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between all documents whose sets of five-word runs are 0.8 similar, and the classes they form."""
    return minhash.similar(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth embedding, among all."""
    return nndescent.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents by source takes of each of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, mixing.cycle)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages of all documents, learned from those outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text", "lang")
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent variant of every word of the documents that has one, and how many words are one edit away."""
    return spelling.forms(spelling.words(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to five words, by the score of their weakest cut."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces of at most 4096 tokens in as few sequences as the search finds."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    length = F.expr("octet_length(ids) div 4").cast("long").alias("length")
    narrow = stored(pieces.select("doc_id", "piece", "start", length, F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.pack(narrow, "length", ["doc_id", "piece", "ids_crc32"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_encoding": op1_bpe_encoding,
    "op2_html_extraction": op2_html_extraction,
    "op3_url_filter": op3_url_filter,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_best_fit_packing": op13_best_fit_packing,
}
