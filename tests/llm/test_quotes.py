import compare
import duckdb
from pyspark.sql import functions as F

from cartlark.llm import quotes

ROWS = [
    (1, 0, "user", "Hello there\nHow are you?"),
    (1, 1, "assistant", "> hello   There\n> how are you?\nFine."),
    (1, 2, "user", ">> Hello there\n>> How are you?\n> Fine.\n\nGood to know"),
    (1, 3, "user", "> nobody said this\nok"), (1, 3, "user", "> Fine.\nok"),
    (1, 4, "x", "> > Good to know\n>\n> ...\n"), (1, 4, "x", "> > Good to know\n>\n> ...\n"),
    (2, 0, "user", "> Hello there\nHow are you?"), (None, 1, "user", "x"), (3, None, None, None),
    (3, 0, "u", ""), (4, 0, "a", "yes"), (4, 1, "b", "yes"), (4, 2, "c", " > yes\n\nyes"),
    (4, 4, "x", "good\n\nyes"), (4, 5, "c", "> good\n"), (4, 9, "c", "> > good\n> yes"),
] + [(5, n, "u", f"> line {n - 1}\nline {n}") for n in range(40)]


def test_links_and_order_equal_sql(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string")
    connection = duckdb.connect()
    connection.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    connection.executemany("insert into conversations values (?, ?, ?, ?)", ROWS)
    found = quotes.reply_order(df.withColumn("thread", F.lit(9)).withColumn("clean", F.lit("x")))
    # Equal rows of one turn are judged alike; joins must not multiply them.
    assert found.count() == len(ROWS)
    sql = quotes.OP4_SQL.replace("left join links l", "left join (select distinct * from links) l")
    assert compare.differences(found, connection, sql) == []
    rows = {(r["conv_id"], r["turn"], r["text"]): r for r in found.collect()}
    assert rows[1, 2, "Good to know"]["parent_turn"] == 1
    assert rows[1, 2, "Good to know"]["depth"] == 2
    assert rows[5, 39, "line 39"]["depth"] == 39 and rows[5, 39, "line 39"]["thread"] == 0


def test_no_messages_and_no_python(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    found = quotes.reply_order(df)
    assert found.isEmpty()
    assert "Python" not in quotes.parsed(df)._jdf.queryExecution().executedPlan().toString()


def test_a_very_long_message(spark):
    text = "\n".join("> " * (n % 3) + f"word {n}" for n in range(20_000))
    df = spark.createDataFrame([(1, 0, "u", text)], "conv_id bigint, turn bigint, role string, text string")
    row = quotes.reply_order(df).first()
    assert row["text"].count("\n") == 6666 and row["n_quotes"] == 13_333


def parents(spark, *texts):
    df = spark.createDataFrame(
        [(1, n, "u", text) for n, text in enumerate(texts)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return [r["parent_turn"] for r in quotes.reply_order(df).orderBy("turn").collect()]


def test_trimmed_quotations_find_their_message(spark):
    first = "first line\nsecond line\n\nanother paragraph\nof two lines"
    assert parents(spark, first, "> second line\nyes", "> another paragraph\n> of two lines\nno",
                   "> first line\n\n> another   PARAGRAPH\nboth", "> of two\nno such line") == [
        None, 0, 0, 0, None]
    # Blank lines of the reply need not be marked.
    assert parents(spark, "A1\n\nB1", "> A1\n\n> B1\nboth") == [None, 0]
    # A whole passage goes before a line of it, whatever is later.
    assert parents(spark, "yes\nno", "no", "> yes\n> no\nfine", "> maybe\n> no\nfine") == [
        None, None, 0, 0]
    # The lowest level goes before larger units.
    assert parents(spark, "a b\nc d", "e f\ng h", ">> a b\n>> c d\n> g h\nx") == [None, None, 1]


def test_very_many_marks_and_blanks_take_no_stack_and_no_time(spark):
    blanks = "a" + " " * 1_000_000 + "b"
    found = parents(spark, blanks, ">" * 200_000 + " deep", "> > " * 50_000 + "\n> a b\nreply")
    assert found == [None, None, 0]
