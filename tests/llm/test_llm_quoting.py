import duckdb
import pyarrow as pa
from test_queries import by_name

from tallyrec.llm.queries import QUOTATIONS_SQL
from tallyrec.llm.quoting import link_quotations, write_conversations

CHAT = [
    (1, 0, "Hello there my friend.\nHow are you today?\n\nSecond paragraph here."),
    (1, 1, "On Monday X wrote:\n> Hello  THERE my friend.\n> How are you today?\n\nI am fine, thanks."),
    (1, 2, "> > How are you today?\n> I am fine, thanks.\n\nGood to hear\n> Second paragraph\n"),
    (1, 3, ">> I am fine, thanks.\n>ok\nfree text\n\n> unknown words here"),
    (2, 0, None),
    (2, 1, ""),
    (2, 2, "> Hello there my friend."),
    (3, 0, "a > b\n\ttab\n"),
    (3, 1, "> a > b\nreply"),
    (4, 5, "dup dup"),
    (4, 6, ">dup dup\nfoo bar"),
    (4, 7, "> foo bar\n\n\n\nbaz"),
    (4, 8, "  > baz baz\n> foo bar\r\nyes"),
    (4, 9, "> later words here"),
    (4, 10, "later words here"),
    *[(5, i, f"> message number {i - 1}\nmessage number {i}") for i in range(40)],
    *[(7, i, t) for i, t in enumerate(["Yes.", "> yes.\nWhy?", "> Why?\n今日は天気", "> 今日は天気\nso", "> so"])],
    *[(6, i, "we all say the same\n> we all say the same") for i in range(30)],
]


def table(rows):
    return pa.table(
        {
            "conv_id": pa.array([r[0] for r in rows], pa.int64()),
            "turn": pa.array([r[1] for r in rows], pa.int64()),
            "role": pa.array(["user"] * len(rows), pa.string()),
            "text": pa.array([r[2] for r in rows], pa.string()),
            "row": pa.array([1] * len(rows), pa.int32()),
            "hash": pa.array(["x"] * len(rows), pa.string()),
            "lines": pa.array(["y"] * len(rows), pa.string()),
        }
    )


def test_against_sql(spark):
    chat = table(CHAT)
    found = link_quotations(spark.createDataFrame(chat))
    duck = duckdb.connect()
    duck.register("conversations", chat)
    wanted = duck.execute(QUOTATIONS_SQL)
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert by_name(found.columns, found.collect()) == by_name(columns, wanted.fetchall())


def test_by_hand(spark):
    found = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame(table(CHAT))).collect()}
    answer = found[1, 1]
    assert (answer.text, answer.reply_to, answer.n_linked) == ("I am fine, thanks.", 0, 1)
    assert (found[1, 2].reply_to, found[1, 2].thread, found[1, 2].depth) == (1, 0, 2)
    assert found[2, 0].text is None and found[2, 1].text == "" and found[2, 2].reply_to is None
    assert found[3, 0].text == "a > b\n\ttab\n"
    assert found[4, 9].reply_to is None  # the original comes later
    assert (found[5, 39].thread, found[5, 39].depth) == (0, 39)
    assert all(found[6, i].reply_to == 0 for i in range(1, 30))


def test_odd_rows(spark):
    rows = [(None, 0, "own words"), (None, 1, "> own words"), (7, None, "> x y"), (8, 1, "a b"), (8, 1, "a b")]
    rows += [(8, 2, "> a b"), (8, 2, "> a b"), (9, 0, "> " * 50 + "deep\n" + "line\n" * 500)]
    found = link_quotations(spark.createDataFrame(table(rows))).collect()
    assert len(found) == len(rows)
    assert all(r.reply_to is None for r in found if r.conv_id != 8 or r.turn == 1)
    assert [r.reply_to for r in found if r.conv_id == 8 and r.turn == 2] == [1, 1]
    empty = spark.createDataFrame(table(rows)).limit(0)
    assert link_quotations(empty).count() == 0


def test_one_word_and_unspaced_quotes(spark):
    rows = [(1, 0, "Yes."), (1, 1, "> yes.\nWhy?"), (1, 2, "> Why?\nso")]
    rows += [(2, 0, "今日は天気がいいですね。"), (2, 1, "> 今日は天気がいいですね。\n本当に"), (2, 2, "> 本当に")]
    rows += [(3, 0, "\t"), (3, 1, ">\t\nno words quoted")]
    found = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame(table(rows))).collect()}
    for conv in (1, 2):
        got = [(found[conv, i].reply_to, found[conv, i].thread, found[conv, i].n_linked) for i in range(3)]
        assert got == [(None, 0, 0), (0, 0, 1), (1, 0, 1)]
    assert found[3, 1].reply_to is None


def test_written_in_reply_order(spark, folder):
    write_conversations(spark.createDataFrame(table(CHAT)), f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == len(CHAT)
