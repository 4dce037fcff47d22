"""The pipeline's stages, each on its own input."""

import corpus_pipeline as cp
import tiktoken
import public_tokenizers
from pyspark.sql import functions as F

from tandem.llm import bpe, mixing, secrets, simhash, toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    clean = cp.toxicity_stage(spark, docs, SF).cache()
    assert clean.columns == columns
    scored = toxicity.op1(docs, labels)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()}
    single = cp.near_duplicate_stage(spark, clean, SF).cache()
    groups = simhash.op4(clean)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())
    safe = cp.secrets_stage(spark, single, SF).cache()
    assert safe.columns == columns and safe.count() == single.count()
    real = secrets.op3(single).where("is_secret")
    assert safe.join(real, "doc_id").where(F.col("text").contains(F.col("candidate"))).count() == 0
    untouched = single.join(real, "doc_id", "left_anti")
    assert untouched.exceptAll(safe).count() == 0
    mixed = cp.mixing_stage(spark, safe, SF).cache()
    assert mixed.columns == columns
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in mixing.op7(safe).where("selected").collect()}
    last = cp.encoding_stage(spark, mixed, SF).collect()
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(last) == mixed.count() and all(r.n_tokens == len(tik.encode_ordinary(r.text)) for r in last)
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == sorted(r.doc_id for r in last)


def test_run_on_odd_rows(spark, odd, empty, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(8, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() >= 1
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0


def test_encoding_stage_hands_on_the_ids(spark, odd):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = cp.encoding_stage(spark, odd, SF).collect()
    assert len(rows) == odd.count() and all(list(r.ids) == tik.encode_ordinary(r.text or "") for r in rows)


def test_stages_hand_on_columns_of_any_name(spark, odd):
    """Columns named like the operators' own, repeated ids with other columns."""
    names = ("n_tokens", "ids", "ids_sha256", "__id", "__row", "__p", "__x", "__take", "__of", "doc", "row", "c", "text_parts", "kept", "score",
             "bpe", "fp", "root", "spans", "new", "id", "rank", "cell", "w", "topic", "c_parts", "changed", "of")
    docs = odd.withColumns({n: F.lit(n) for n in names}).withColumn("a.b", F.lit(1))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[n] == n for r in out.collect() for n in names), name
    out = cp.encoding_stage(spark, docs, SF)
    assert sorted(c.lower() for c in out.columns) == sorted({*(c.lower() for c in docs.columns), "decoded_sha256"})
    out.write.format("noop").mode("overwrite").save()


def test_the_kept_row_does_not_depend_on_the_order(spark):
    rows = [(1, "one two three four", "de", "s1", 18), (1, "one two three four", "en", "s2", 18), (1, "one two three four", None, "s3", 18),
            (None, "a b c d", "x", None, 7), (None, "a b c d", "w", "q", 7), (2, None, "z", "z", None), (2, None, "y", "z", None)]
    kept = set()
    for k in range(4):
        some = rows[k:] + rows[:k]
        df = spark.createDataFrame(some if k % 2 else some[::-1], "doc_id long, text string, lang string, source string, n_chars long")
        kept.add(tuple(sorted(map(str, cp.near_duplicate_stage(spark, df.repartition(1 + k), SF).collect()))))
    assert len(kept) == 1 and len(next(iter(kept))) == 3


def test_the_secret_pattern_runs_once(spark, odd):
    """In the plan of the scan and of the stage's writing job."""
    from tandem.llm import secrets as S
    rows = odd.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    for df in (S.scan(odd), S.with_candidates(rows, "text", "c")):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("regexp_replace(translate(text") == 1


def test_codecs_of_earlier_runs_leave_the_workers(spark, odd):
    """Workers outlive a run: what they hold must not grow with the number of runs."""
    from tandem.llm.common import vector_udf
    for _ in range(2):
        odd.select(bpe.encoded(F.col("text"), spark, fields=("n_tokens",))).collect()

    @vector_udf("int")
    def codecs(texts):
        import gc
        import pandas as pd
        gc.collect()
        return pd.Series([sum(isinstance(x, bpe.TextCodec) for x in gc.get_objects())] * len(texts))

    assert {r.n for r in odd.select(codecs("text").alias("n")).collect()} == {0}
