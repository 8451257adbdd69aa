from __future__ import annotations

from pyspark.sql import functions as F

from pricefold.llm import common, language


def test_held_out_accuracy(spark, sf_dir):
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    told = docs.withColumn("lang", F.when(~held, F.col("lang"))).withColumn("truth", F.col("lang")).drop("truth")
    found = language.identified(told.withColumn("source", F.lit("one"))).select("doc_id", "identified.*")
    truth = docs.where(held).select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) > 50
    assert sum(row.language == row.lang for row in rows) >= 0.97 * len(rows)


def test_clean_documents_are_kept(spark, sf_dir):
    from pricefold.llm.queries import op3_language, table

    rows = op3_language(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(row.kept for row in rows)


def test_documents_of_all_kinds(spark, odd_documents, no_documents):
    clash = odd_documents.withColumn("identified", F.lit(1)).withColumn("_llm_h", F.lit(2)).withColumn("doc", F.lit(3))
    found = language.identified(clash)
    assert found.columns == ["doc_id", "text", "lang", "source", "size", "shard", "_llm_h", "doc", "identified"]
    rows = found.collect()
    assert len(rows) == clash.count()
    for row in rows:
        if not row.text or not row.text.strip():
            assert row.identified.language is None and not row.identified.kept
    assert language.identified(no_documents).collect() == []


def test_host_and_declaration_decide_where_the_text_does_not(spark, sf_dir):
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents").select("text", "lang", F.concat("lang", F.lit(".org")).alias("host"))
    unclear = spark.createDataFrame([("e e", None, "de.org"), ("e e", "es", "new.net")], "text string, lang string, host string")
    found = language.identified(docs.union(unclear), host="host", evidence=2).where("length(text) = 3").collect()
    assert {(row.host, row.identified.language) for row in found} == {("de.org", "de"), ("new.net", "es")}


def test_letters_at_random_are_no_language(spark, sf_dir):
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    noise = spark.createDataFrame([("qxzkv wjqpx zzkqj vxwqk jjxqz kvwzx " * 20, None, "src1")], docs.schema)
    (row,) = language.identified(docs.union(noise)).where("text like 'qxzkv%'").collect()
    assert not row.identified.kept and row.identified.language is None


def test_keys_and_addresses_do_not_count(spark, sf_dir):
    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    (text,) = docs.where("lang = 'en' and length(text) > 60").select("text").first()
    odd = f"{text[:40]} token = d79b4bd5ac35c6fd4765f3c195ae8bf92c95a355 ldlooirp.70@mail5.example.com"
    noise = spark.createDataFrame([(odd, "en", "src1")], docs.schema)
    (row,) = language.identified(docs.union(noise)).where("text like '%d79b4bd5%'").collect()
    assert row.identified.kept and row.identified.language == "en"


def test_pages(spark, sf_dir):
    from pricefold.llm.queries import table

    pages = table(spark, sf_dir, "pages")
    odd = spark.createDataFrame([(1, None, None), (2, "not a url", "<html lang='FR'>x"), (None, "http://a.b.fr:80/x", "")], pages.schema)
    evidence = language.page_evidence(pages.union(odd))
    found = language.identified(evidence, declared="declared", host="host", suffix="suffix")
    assert found.count() == pages.count() + 3
    assert found.where("declared != identified.language").count() <= 0.02 * pages.count()
    assert {tuple(row) for row in language.page_evidence(odd).select("declared", "host", "suffix").collect()} == {
        (None, None, None), ("fr", None, None), (None, "a.b.fr", "fr")
    }


def test_a_registered_query_identifies_all_pages(spark, sf_dir):
    import __spark_entry__ as entry
    from pricefold.llm.queries import table

    pages = table(spark, sf_dir, "pages")
    rows = entry.queries()["pages_language"](spark, sf_dir).collect()
    assert sorted(row.page_id for row in rows) == sorted(row.page_id for row in pages.select("page_id").collect())
    assert all(row.suffix and row.host.endswith(row.suffix) for row in rows if row.host)
    assert any(row.declared for row in rows) and any(row.language for row in rows)


def test_the_training_draw_counts_labelled_texts_and_each_text_once(spark):
    """Few labelled rows among many, and one text that holds a third of them."""
    docs = spark.range(20_000).selectExpr("if(id % 3 = 0, 'the same', concat('text ', id)) as text")
    labelled = docs.distinct().withColumn("declared", F.lit("en"))
    assert 400 < common.drawn(labelled, 500).count() < 600
    copied = docs.union(docs).withColumn("declared", F.lit("en"))
    rows = common.drawn(copied, 500)
    assert 400 < rows.count() < 600 and rows.distinct().count() == rows.count()

    few = spark.range(300).selectExpr("concat('le chat ', id) as text", "'fr' as declared")
    rest = docs.selectExpr("text", "cast(null as string) as declared").limit(9_000)
    whole = language.trained(few, language.LANGUAGES, 1_000)
    assert (language.trained(few.union(rest), language.LANGUAGES, 1_000) == whole).all()
    assert (language.trained(few.union(few), language.LANGUAGES, 1_000) == whole).all()


def test_open_markup_takes_one_pass(spark):
    """Pages of a megabyte that leave everything open; a pattern that looked for each end anew would take hours."""
    import time

    size = 1_000_000
    pages = [
        (1, "<!-- x " * (size // 7)), (2, "<script> x " * (size // 11)), (3, "a < b " * (size // 6)), (4, "<html " * (size // 6)),
        (5, "<p>one</p> < two <!-- three --> four <b"), (6, None), (7, "x<style>y</style>z<!-- open <p>gone</p>"), (8, ""),
    ]
    start = time.monotonic()
    frame = spark.createDataFrame([(k, "http://a.example.de/", html) for k, html in pages], "page_id long, url string, html string")
    found = {row.page_id: row for row in language.page_evidence(frame).collect()}
    assert time.monotonic() - start < 60
    assert found[1].text == found[2].text == " " and found[3].text == pages[2][1] and found[4].text == pages[3][1]
    assert found[5].text == " one  < two   four <b" and found[6].text is None and found[7].text == "x z " and found[8].text == ""
