"""Shared folders, resumed pipelines, long conversations and pages."""

import importlib

import pytest

from bescheid.llm import chat, common, html_text

pipe = importlib.import_module("corpus_pipeline")


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(_, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():  # noqa: N802
            return None


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        common.base_dir(Cluster())


def test_resume(spark, sf, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/run"
    rows = lambda df: sorted(map(str, df.drop("sequence_id", "offset").collect()))
    first = rows(pipe.run(spark, sf, folder))
    assert all(common.finished(spark, f"{folder}/{n}") for n, _ in pipe.STAGES[:-1]) and not common.finished(spark, f"{folder}/none")

    def never(*_):
        raise AssertionError("a finished stage ran again")

    monkeypatch.setattr(pipe, "STAGES", [(n, never if n != "packing" else s) for n, s in pipe.STAGES])
    assert rows(pipe.run(spark, sf, folder)) == first


def test_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} " * (2000 if i == 7 else 3)) for i in range(120)]
    got = chat.read_back(chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert got.n_turns == 120 and got.loss_chars == sum(len(t) for *_, r, t in rows if r == "assistant")


def test_long_page():
    page = "<nav>" + "<a href=x>Home</a>" * 500 + "</nav><article>" + "".join(f"<p>Paragraph number {i} of the long article, with a few words.</p>" for i in range(20_000)) + "</article>"
    text = html_text.main_texts([page], html_text.labeller())[0]
    assert text.count("\n") == 19_999 and "Home" not in text
