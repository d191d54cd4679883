import os
import shutil
import tempfile

import numpy as np
import pytest

from conftest import MAIN_IDS, WIDTH, np_fisher, to_dense
from cohortmx.streaming.subjects import fisher_stream, fisher_table, running_split_stats, running_stats, stream_rejects


def test_stream_maps_each_file_and_stats_match(spark, main_dir):
    src_dir, mats = main_dir
    base = tempfile.mkdtemp(prefix="cohortmx-stream-")
    inbox, table, ckpt = (os.path.join(base, p) for p in ("in", "table", "ckpt"))
    os.makedirs(inbox)
    # first three subjects arrive, the stream runs; then the rest arrive
    for sid in MAIN_IDS[:3]:
        shutil.copy(os.path.join(src_dir, f"sub{sid}.txt"), inbox)
    fisher_stream(spark, inbox, table, ckpt, width=WIDTH).awaitTermination()
    assert sorted({r["subject_id"] for r in fisher_table(spark, table).collect()}) == MAIN_IDS[:3]
    for sid in MAIN_IDS[3:]:
        shutil.copy(os.path.join(src_dir, f"sub{sid}.txt"), inbox)
    fisher_stream(spark, inbox, table, ckpt, width=WIDTH).awaitTermination()
    rows = fisher_table(spark, table).collect()
    assert len(rows) == len(MAIN_IDS) * WIDTH * (WIDTH + 1) // 2
    F_all = np.stack([np_fisher(mats[s])[1] for s in MAIN_IDS])
    st = running_stats(spark, table).collect()
    assert np.allclose(to_dense(st, col="mean"), F_all.mean(0), atol=1e-12)
    assert np.allclose(to_dense(st, col="var"), F_all.var(0), atol=1e-12)
    sp = running_split_stats(spark, table).collect()
    for split, ids in (("train", MAIN_IDS[:3]), ("test", MAIN_IDS[3:])):
        want = np.mean([np_fisher(mats[s])[1] for s in ids], axis=0)
        assert np.allclose(to_dense([r for r in sp if r["split"] == split], col="mean"), want, atol=1e-12)


def test_stream_refuses_or_keeps_rejects(spark, main_dir):
    src_dir, mats = main_dir
    base = tempfile.mkdtemp(prefix="cohortmx-stream-")
    inbox = os.path.join(base, "in")
    os.makedirs(inbox)
    good = open(os.path.join(src_dir, f"sub{MAIN_IDS[0]}.txt")).read()
    for name, text in ((f"sub{MAIN_IDS[0]}.txt", good.rstrip() + "\n1 2 x 4\n1 2 3\n"), ("subject.txt", "1 2 3 4")):
        with open(os.path.join(inbox, name), "w") as fh:
            fh.write(text)

    def paths(name):
        return [os.path.join(base, name + end) for end in ("-table", "-ckpt")]

    with pytest.raises(Exception, match="row|no subject id"):
        fisher_stream(spark, inbox, *paths("strict"), width=WIDTH).awaitTermination()
    table, ckpt = paths("counted")
    fisher_stream(spark, inbox, table, ckpt, width=WIDTH, strict=False).awaitTermination()
    got = sorted((r.file_name, r.row_idx, r.reason) for r in stream_rejects(spark, table).collect())
    n = len(mats[MAIN_IDS[0]])
    assert got == [(f"sub{MAIN_IDS[0]}.txt", n, "not a number"), (f"sub{MAIN_IDS[0]}.txt", n + 1, "wrong number of values"),
                   ("subject.txt", 0, "no subject id in name")]
    assert {(r.subject_id, r.n) for r in fisher_table(spark, table).collect()} == {(MAIN_IDS[0], n)}


def test_a_subject_sent_again_counts_once_by_its_newest_file(spark):
    base = tempfile.mkdtemp(prefix="cohortmx-stream-")
    inbox, table, ckpt = (os.path.join(base, p) for p in ("in", "table", "ckpt"))
    os.makedirs(inbox)
    rng = np.random.default_rng(1)
    mats = {name: rng.normal(size=(20, WIDTH)) for name in ("sub100001.txt", "sub100002.txt", "sub0100001.txt")}
    for batch in (("sub100001.txt", "sub100002.txt"), ("sub0100001.txt",)):
        for name in batch:
            np.savetxt(os.path.join(inbox, name), mats[name])
        fisher_stream(spark, inbox, table, ckpt, width=WIDTH).awaitTermination()
    want = np.stack([np_fisher(mats[n])[1] for n in ("sub0100001.txt", "sub100002.txt")])
    st = running_stats(spark, table).collect()
    assert np.allclose(to_dense(st, col="mean"), want.mean(0), atol=1e-12) and {r["n"] for r in st} == {2}
