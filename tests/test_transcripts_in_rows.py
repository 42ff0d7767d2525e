"""Lines and blocks are found inside the row of a file, and are those of the grouped way, whatever rows share a path."""

from tracelake.sources import chat_events, markdown_chat as chat

TEXTS = [
    "before\n# aider chat started at a\n> t\n#### u\n#### v\n   \n\n#### w\nanswer\n> \n# aider chat started at b\n  \n#### /add x y\nmore\n",
    "# aider chat started at only", "no header\n", "", None, "# aider chat started at c\r\n> a > b\x0cc\rd\n\n> e\r" * 3,
]


def made(spark, paths):
    return spark.createDataFrame([(p, t, 1) for p, t in zip(paths, TEXTS)], "path string, text string, modified long")


def blocks(df):
    return sorted(map(str, chat.blocks(df).collect()))


def test_lines_and_blocks_need_no_shuffle(spark):
    files = made(spark, "abcdef")
    for df in (chat.lines(files), chat.blocks(chat.lines(files, by_session=True))):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    flat = chat.lines(files)
    assert blocks(chat.lines(files, by_session=True)) == blocks(flat)
    assert sorted({r["path"] for r in flat.collect()}) == ["a", "b", "f"]


def test_rows_that_share_a_path_are_one_file(spark):
    """As the windows over the path counted them: a header that comes twice opens a session for each."""
    twice = made(spark, "abcdef").filter("path in ('a', 'b')")
    files = twice.unionByName(twice.filter("path = 'a'")).unionByName(twice.filter("path = 'b'").selectExpr("null as path", "text", "modified"))
    want = sorted(map(str, chat._across_rows(files).collect()))
    assert sorted(map(str, chat.lines(files).collect())) == want
    assert blocks(chat.lines(files, by_session=True)) == blocks(chat.lines(files))
    assert sorted({r["session_index"] for r in chat.lines(files).filter("path = 'a'").collect()}) == [0, 1, 2, 3]
    assert chat.lines(files).filter("path is null").count() == 1
    for df in (chat.lines(files), chat.lines(files, by_session=True)):
        placed = chat.blocks(df).filter("path = 'a'").orderBy("session_index", "block_no").select("session_index", "start_line", "end_line").collect()
        assert placed == sorted(placed)


def test_extents_split_a_text_once(spark):
    plan = chat.extents(made(spark, "abcdef"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_the_text_of_a_prompt_is_stripped_once():
    assert chat_events._user_fields("content").count("content") == 1
