from __future__ import annotations

import json

import pytest

from textloom import cli

BPE = "/opt/tokenizers/byte_bpe_50k.json"
GOOD = "The quick brown fox jumps over the lazy dog near the river bank today"


@pytest.fixture
def corpus(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text(f"{GOOD}\n{GOOD}\nshort\n")
    (d / "b.txt").write_text(f"{GOOD}\nYou stupid thing, the election in the city was a long time ago\n")
    return d


def run(capsys, *argv):
    cli.main(list(map(str, argv)))
    return dict(x.split("=", 1) for x in capsys.readouterr().out.splitlines() if "=" in x)


def test_reports_and_cleaning(spark, corpus, tmp_path, capsys):
    out = run(capsys, "corpus-quality-report", "--input", corpus, "--output", tmp_path / "q.json", "--min-occurrences", 3, "--min-files", 2)
    assert out["lines_seen"] == "5" and out["lines_duplicate"] == "2"
    assert json.loads((tmp_path / "q.json").read_text())["boilerplate_candidates"][0]["line"] == GOOD
    out = run(capsys, "clean-corpus-batch", "--input", corpus, "--output", tmp_path / "clean", "--boilerplate-report", tmp_path / "q.json", "--report", tmp_path / "c.json")
    assert out == {"boilerplate": "3", "kept": "1", "too_short": "1"}
    out = run(capsys, "dataset-risk-report", "--input", corpus, "--output", tmp_path / "r.json")
    assert out["lines_with_toxicity"] == "1" and out["lines_with_political"] == "1"
    out = run(capsys, "stats", "--input", corpus / "a.txt")
    assert out["chars"] == str(2 * len(GOOD) + 8) and out["lines"] == "3"
    with pytest.raises(SystemExit):
        cli.main(["corpus-quality-report", "--input", str(corpus), "--pattern", "*.none", "--output", str(tmp_path / "x.json")])


@pytest.mark.parametrize("split", ["hash", "sequence"])
def test_shards_and_their_verification(spark, corpus, tmp_path, capsys, split):
    out = run(capsys, "shard-corpus", "--input", corpus, "--tokenizer", BPE, "--output", tmp_path / "s", "--shard-size", 16, "--val-ratio", 0.4, "--split", split)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    text = [x for f in ("a", "b") for x in (corpus / f"{f}.txt").read_text().splitlines(True)]
    assert int(out["train_tokens"]) + int(out["val_tokens"]) == sum(len(t.encode(x).ids) for x in text)
    assert run(capsys, "verify-shards", "--path", tmp_path / "s", "--tokenizer", BPE, "--check-ranges")["ok"] == "True"
    with pytest.raises(FileExistsError):
        cli.main(["shard-corpus", "--input", str(corpus), "--tokenizer", BPE, "--output", str(tmp_path / "s")])
    with open(next((tmp_path / "s").glob("*.bin")), "ab") as f:
        f.write(b"x")
    with pytest.raises(SystemExit):
        cli.main(["verify-shards", "--path", str(tmp_path / "s")])
    assert "size_mismatch" in capsys.readouterr().out


def test_batches_duplicates_and_conversion(spark, corpus, tmp_path, capsys):
    out = run(capsys, "shard-corpus-batch", "--input", corpus, "--tokenizer", BPE, "--output", tmp_path / "b")
    assert set(out) == {"a", "b"} and out["a"].startswith("ok:")
    assert run(capsys, "shard-corpus-batch", "--input", corpus, "--tokenizer", BPE, "--output", tmp_path / "b")["a"] == "skipped_existing"
    (tmp_path / "b/copy").mkdir()
    (tmp_path / "b/copy/manifest.json").write_text((tmp_path / "b/a/manifest.json").read_text())
    out = run(capsys, "manifest-dedupe", "--path", tmp_path / "b", "--dry-run")
    assert out["manifest_total"] == "3" and out["manifest_kept"] == "2"
    run(capsys, "manifest-dedupe", "--path", tmp_path / "b")
    assert len(list((tmp_path / "b").rglob("manifest.json.disabled"))) == 1
    import pandas as pd

    pd.DataFrame({"text": [GOOD + GOOD, None, "x"]}).to_parquet(tmp_path / "p.parquet")
    out = run(capsys, "parquet-to-corpus", "--input", tmp_path / "p.parquet", "--output", tmp_path / "c")
    assert out == {"p.parquet": "seen:3,written:1,short:1"}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/a.html").write_text("<p>" + GOOD * 4 + "</p><script>x</script>")
    run(capsys, "extract-text", "--input", tmp_path / "pages", "--output", tmp_path / "text")
    assert GOOD in "".join(p.read_text() for p in (tmp_path / "text").glob("*.txt"))


def test_cleaning_options_and_what_is_there_already(spark, corpus, tmp_path, capsys):
    out = run(capsys, "clean-corpus-batch", "--input", corpus, "--output", tmp_path / "o", "--no-dedupe-within", "--min-chars", 3, "--min-words", 1, "--no-drop-code", "--max-digit-ratio", 0.5)
    assert out == {"kept": "5"}
    assert {p.name for p in (tmp_path / "o").iterdir()} == {"a.clean.txt", "b.clean.txt"}
    (corpus / "c.txt").write_text(GOOD + "\n")
    out = run(capsys, "clean-corpus-batch", "--input", corpus, "--output", tmp_path / "o")
    assert out == {"skipped_existing": "2", "kept": "1"}
    assert run(capsys, "clean-corpus-batch", "--input", corpus, "--output", tmp_path / "o") == {"skipped_existing": "3"}
    assert run(capsys, "clean-corpus-batch", "--input", corpus, "--output", tmp_path / "o", "--force")["kept"] == "4"
    with pytest.raises(ValueError, match="ratios"):
        cli.main(["clean-corpus-batch", "--input", str(corpus), "--output", str(tmp_path / "x"), "--min-alpha-ratio", "2"])


def test_parquet_to_shards_and_files_that_cannot_be_read(spark, tmp_path, capsys):
    import pandas as pd
    from tokenizers import Tokenizer

    d = tmp_path / "p"
    d.mkdir()
    pd.DataFrame({"text": [GOOD + GOOD, None, "x", GOOD * 3]}).to_parquet(d / "a.parquet")
    (d / "bad.parquet").write_bytes(b"no parquet")
    pd.DataFrame({"other": ["x"]}).to_parquet(d / "c.parquet")
    with pytest.raises(SystemExit):
        cli.main(["parquet-to-shards", "--input", str(d), "--tokenizer", BPE, "--output", str(tmp_path / "s"), "--shard-size", "16"])
    out = dict(x.split("=", 1) for x in capsys.readouterr().out.splitlines())
    t = Tokenizer.from_file(BPE)
    assert int(out["train_tokens"]) + int(out["val_tokens"]) == sum(len(t.encode(x + "\n").ids) for x in (GOOD + GOOD, GOOD * 3))
    assert out["rows_sharded"] == "2" and out["c.parquet"] == "skipped:missing_field:text" and out["bad.parquet"].startswith("skipped:unreadable")
    assert run(capsys, "verify-shards", "--path", tmp_path / "s", "--tokenizer", BPE, "--check-ranges")["ok"] == "True"
    with pytest.raises(SystemExit):
        cli.main(["parquet-to-corpus", "--input", str(d), "--output", str(tmp_path / "c")])
    assert "a.parquet=seen:4,written:2,short:1" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["parquet-to-corpus", "--input", str(d), "--output", str(tmp_path / "c")])
    assert "a.parquet=skipped_existing" in capsys.readouterr().out
