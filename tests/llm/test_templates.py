"""op2 finds items whose numbers were exchanged for numbers of another form."""

from glebe.llm import decontaminate


def found(spark, docs, items):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(frame, bench).collect()}


def test_numbers_of_any_form_are_one_slot(spark):
    ask = "A shop sold {} red pens and {} blue pens before noon, then {} of the green ones came back.".format
    docs = [ask("1,250", "3,400", "2.5"), ask("1 250", "3.5", "12 000 000"), "So " + ask("7", "1,000.25", "0.5") + " Really.", ask("1,250", "3,400", "2.5").replace("pens", "cars")]
    assert found(spark, docs, [ask("950", "40", "5"), ask("1,950", "4.75", "5")]) == {(d, i) for d in range(3) for i in range(2)}


def test_names_that_begin_sentences_are_slots(spark):
    ask = "{0} has {3} apples. {1} buys {4} apples from {0}. {2} eats {5} apples. How many apples remain?".format
    items = [ask("Anna", "Bert", "Carl", 5, 3, 2), ask("Anna", "Bert", "Carl", 5, 3, 2).replace(". ", '.\n"')]
    docs = [ask("Emil", "Frida", "Gert", 17, 9, 4), "so " + ask("Emil", "Frida", "Gert", 17, 9, 4) + " Well.", ask("Anna", "Bert", "Carl", 5, 3, 2).upper(),
            ask("Emil", "Frida", "Gert", 17, 9, 4).replace("apples", "pears")]
    assert found(spark, docs, items) == {(d, i) for d in range(3) for i in range(2)}


def test_time_grows_with_the_length_of_a_text(spark):
    import time

    from pyspark.sql import functions as F

    windows = decontaminate.item_windows(spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string"))

    def seconds(words):
        docs = spark.range(1).select(F.col("id").alias("_doc"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("word"), i))).alias("text"))
        began = time.perf_counter()
        assert decontaminate.matches(docs, windows).count() == 0
        return time.perf_counter() - began

    seconds(100)
    assert seconds(40_000) < 4 * seconds(20_000) + 1
