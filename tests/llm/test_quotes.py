from __future__ import annotations

import duckdb

from eventide.llm import queries, quotes

CHAT = "conv_id long, turn long, role string, text string, answers int, key string, level int, body int"


def chat(spark, rows):
    return spark.createDataFrame([(*r, 5, "k", 1, 2) for r in rows], CHAT)


COLUMNS = "conv_id, turn, role, body, quoted_lines, quote_levels, answers, thread_turn"


def by_sql(rows):
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.sql(f"SELECT {COLUMNS} FROM ({queries.SQL['op6_reply_ordered']})").fetchall(), key=str)


def out(df):
    """Messages by place; the registered SQL must give the same rows."""
    rows = quotes.reply_ordered(df).collect()
    said = [tuple(r)[:4] for r in df.collect()]
    assert sorted(map(tuple, rows), key=str) == by_sql(said)
    return {(r.conv_id, r.turn): r for r in rows}


def test_nested_quotes_link_to_their_messages(spark):
    got = out(chat(spark, [
        (1, 0, "user", "Hello there.\nHow are  you?"),
        (1, 1, "assistant", "> How are you?\nFine, thanks.\n\nAnd you?"),
        (1, 2, "user", ">> how are YOU?\n> Fine, thanks.\n> And you?\nGood!"),
        (1, 3, "assistant", "no quote"),
        (1, 4, "user", "> nothing such\nhm"),
        (1, 5, "user", "> Good!\nyes"),
        (2, 0, "user", "> Good!\nquoted from elsewhere")]))
    assert {k: r.answers for k, r in got.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): None, (1, 4): None, (1, 5): 2, (2, 0): None}
    assert {k: r.thread_turn for k, r in got.items() if k[0] == 1} == {
        (1, 0): 0, (1, 1): 0, (1, 2): 0, (1, 3): 3, (1, 4): 4, (1, 5): 0}
    assert got[1, 1].body == "Fine, thanks.\n\nAnd you?" and got[1, 2].body == "Good!"
    assert (got[1, 2].quoted_lines, got[1, 2].quote_levels) == (3, 2)


def test_latest_earlier_message_wins_across_spans(spark, monkeypatch):
    monkeypatch.setattr(quotes, "SPAN", 4)
    rows = [(1, t, "user", "same line") for t in (0, 5, 6, 30)]
    rows += [(1, t, "user", "> same line\nreply") for t in (1, 6, 7, 29, 31)]
    got = out(chat(spark, rows))
    by_turn = {}
    for r in quotes.reply_ordered(chat(spark, rows)).where("quoted_lines > 0").collect():
        by_turn[r.turn] = r.answers
    assert by_turn == {1: 0, 6: 5, 7: 6, 29: 6, 31: 30}
    assert got[1, 31].thread_turn == 30


def test_long_chain_and_hot_line(spark):
    rows = [(1, 0, "user", "start")]
    rows += [(1, t, "user", f"> {'start' if t == 1 else f'line {t - 1}'}\nline {t}")
             for t in range(1, 40)]
    rows += [(2, t, "user", "> ok\nok") for t in range(200)]
    got = out(chat(spark, rows))
    assert all(got[1, t].thread_turn == 0 for t in range(40))
    assert all(got[2, t].answers == (t - 1 if t else None) for t in range(200))
    assert all(got[2, t].thread_turn == 0 for t in range(200))


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "a", ""), (1, 1, "a", ""), (None, 2, "a", "> x\ny"),
            (1, None, "a", "> x\ny"), (1, 2, None, ">\n> \n"), (1, 3, "a", "x"),
            (1, 3, "b", "> x\nother"), (1, 4, "a", "> x\nlater"), (1, 5, "a", "é > not\n" * 5000)]
    got = quotes.reply_ordered(chat(spark, rows)).collect()
    assert len(got) == 9                                  # equal rows count once
    keyed = [r for r in rows if None not in r[:2]]
    assert sorted(map(tuple, quotes.reply_ordered(chat(spark, keyed)).collect()), key=str) == by_sql(keyed)
    answers = {(r.conv_id, r.turn, r.role): r.answers for r in got}
    assert answers[1, 4, "a"] == 3 and answers[1, 3, "b"] is None
    assert quotes.reply_ordered(chat(spark, rows).limit(0)).count() == 0


def test_built_in_functions_only(spark):
    df = quotes.reply_ordered(chat(spark, [(1, 0, "user", "a"), (1, 1, "user", "> a\nb")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quoted_sentences_and_paragraphs_link(spark):
    got = out(chat(spark, [
        (1, 0, "user", "I went there. It was \"shut.\" Should I go again? Tell me."),
        (1, 1, "a", "> Should I go\n> again?\nYes."),
        (1, 2, "user", "> It was \"shut.\" Should I leave?\nOne of two sentences is known."),
        (2, 0, "user", "The first paragraph,\nin two lines\n\nThe second one\n\nAnd the third"),
        (2, 1, "a", "no quote"),
        (2, 2, "user", "> The first\n> paragraph, in two lines\n>\n> The\n> second one\nSo it is."),
        (3, 0, "user", "你好。你在哪里？谢谢。"), (3, 1, "a", "> 你在哪里？\nx"),
        (4, 0, "user", "A sentence over\ntwo lines. Then more"), (4, 1, "a", "> A sentence over two lines.\nx")]))
    assert {k: r.answers for k, r in got.items() if r.quoted_lines} == {
        (1, 1): 0, (1, 2): 0, (2, 2): 0, (3, 1): 0, (4, 1): 0}
    assert got[2, 2].thread_turn == 0 and got[1, 1].body == "Yes."


def test_whole_passages_and_longer_units_come_first(spark):
    got = out(chat(spark, [
        (1, 0, "user", "It rains. Stay in."), (1, 1, "a", "It rains."), (1, 2, "b", "Stay in."),
        (1, 3, "user", "> It rains. Stay in.\nx"),
        (1, 4, "user", "> It rains. Stay in. Now.\nx"),
        (1, 5, "user", "> It rains.\n>\n> Stay in, all of you.\nx")]))
    assert [got[1, t].answers for t in (3, 4, 5)] == [0, 1, 1]
