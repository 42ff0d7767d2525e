"""Files of a landing folder are listed and read by the tasks, as Spark's own sources would."""

from tracelake.harness import events
from tracelake.session import CLEANUP
from tracelake.sources import landing, markdown_chat as chat
from tracelake.streaming import arrivals, incremental

TEXT = b"# aider chat started at 2024\n\xff bad\r\n\n> a"
NAMES = ["aider.a b.chat.md", "aider.é%#.chat.md", "aider.{x}[1].chat.md", "_aider.chat.md", ".aider.chat.md", "aider.empty.chat.md", "sub/aider.1.chat.md",
         ".hid/aider.2.chat.md", "_x=1/aider.3.chat.md", "_y/aider.4.chat.md", "sub/deep er/aider.5.chat.md", "aider.bom.chat.md", "other.md"]


def test_same_rows_as_spark_sources(spark, tmp_path, monkeypatch):
    for name in NAMES:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else b"\xef\xbb\xbf" * ("bom" in name) + TEXT)
    folder = str(tmp_path)

    def rows():
        read = chat.read_transcripts(spark, folder), chat.read_lines(spark, folder), incremental.file_listing(spark, folder, "aider*.chat*.md")
        return [sorted(map(str, df.collect())) for df in read]

    mine = rows()
    monkeypatch.setattr(landing, "find", lambda *a: None)
    assert mine == rows() and [len(x) for x in mine] == [7, 28, 7]


def test_the_driver_has_no_file_of_the_folder(spark, tmp_path):
    for n in range(30):
        (tmp_path / f"aider.{n}.chat.md").write_bytes(TEXT)
    folder = str(tmp_path)
    for df in (chat.read_transcripts(spark, folder), chat.read_lines(spark, folder), incremental.file_listing(spark, folder, "aider*")):
        assert not [f for f in df.inputFiles() if "aider." in f]
        assert df.select("path").distinct().count() == 30


def test_a_batch_of_the_stream_is_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """A batch costs its jobs however few files it has: small files make one batch, unless the caller bounds their number."""
    land = tmp_path / "land"
    land.mkdir()
    for n in range(1100):
        (land / f"aider.{n}.chat.md").write_bytes(TEXT)

    def batches(name, **k):
        assert arrivals.snapshot(spark, str(land), str(tmp_path / name), **k)
        return len(list((tmp_path / name).rglob("*.parquet")))

    assert batches("a") == 1 and batches("b", files_per_batch=1000) >= 2
    monkeypatch.setattr(arrivals, "BATCH_BYTES", 400 * len(TEXT))
    assert batches("c") == 3
    assert spark.read.parquet(str(tmp_path / "c")).select("path").distinct().count() == 1100


def test_shuffle_files_go_with_the_batch(spark, tmp_path, monkeypatch):
    (tmp_path / "aider.a.chat.md").write_bytes(TEXT)
    seen, plain = [], arrivals.ingest_files
    monkeypatch.setattr(arrivals, "ingest_files", lambda s, *a: seen.append(s.conf.get(CLEANUP)) or plain(s, *a))
    before = spark.conf.get(CLEANUP)
    assert arrivals.refresh(spark, str(tmp_path), str(tmp_path / "base"))
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before


def test_shuffle_files_go_once_a_table_is_stored(spark, tmp_path):
    """What the report shuffles must not lie beside what its table was made from."""
    seen = []

    def make():
        seen.append(spark.conf.get(CLEANUP))
        return spark.range(3)

    before = spark.conf.get(CLEANUP)
    assert events.stored(f"t-{tmp_path.name}", spark, str(tmp_path), make).count() == 3
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before
