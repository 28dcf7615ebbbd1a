"""The command line: every job on small text files, outputs in the original formats."""

from __future__ import annotations

import glob
import os

from statforge.cli import main


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def _read(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        out.extend(open(f).read().splitlines())
    return out


def _parts(path):
    return [open(f).read().splitlines() for f in sorted(glob.glob(os.path.join(path, "part-*")))]


def test_summary_jobs(spark, workdir):
    row = lambda v, k, flag: ",".join(["x"] * 3 + [v] + ["y"] * 25 + list(k) + [flag])
    inp = _write(os.path.join(workdir, "flags.csv"), "\n".join([row("2", "abcd", "false"), row("4", "abcd", "FALSE"), row("9", "abcd", "true")]) + "\n")
    main(["flag-mean", inp, os.path.join(workdir, "o1")], spark=spark)
    assert _read(os.path.join(workdir, "o1")) == ["a, b, c, d\t3.0"]

    st = "0" * 15 + "1901" + " " * 68 + "+0317" + "1" + "\n" + "0" * 15 + "1901" + " " * 68 + "-0020" + "0" + "\n"
    main(["station-max", _write(os.path.join(workdir, "st.txt"), st), os.path.join(workdir, "o2")], spark=spark)
    assert _read(os.path.join(workdir, "o2")) == ["1901\t317"]

    year_recs = ",".join(["0", "Title", "Abba", "200.5"] + ["z"] * 161 + ["2004"]) + "\n"
    year_recs += ",".join(["0", "T2", "Zappa", "100.0"] + ["z"] * 161 + ["1990"]) + "\n"
    main(["year-project", _write(os.path.join(workdir, "years.csv"), year_recs), os.path.join(workdir, "o3")], spark=spark)
    assert _read(os.path.join(workdir, "o3")) == ["Abba\t200.5\tTitle\t2004"]

    recs = "0,t,Abba,1.5\n0,t,Abba,2.5\n0,t,Kiss,3.0\n0,t,Zappa,-1\n"
    main(["range-max", _write(os.path.join(workdir, "m.csv"), recs), os.path.join(workdir, "o4"), "--parts-per-bucket", "1"], spark=spark)
    assert sorted(_read(os.path.join(workdir, "o4"))) == ["Abba\t2.5", "Kiss\t3.0", "Zappa\t0.0"]
    main(["range-max", os.path.join(workdir, "m.csv"), os.path.join(workdir, "o4b"), "--parts-per-bucket", "2"], spark=spark)
    assert _read(os.path.join(workdir, "o4b")) == ["Abba\t2.5", "Kiss\t3.0", "Zappa\t0.0"]

    uni = _write(os.path.join(workdir, "uni.txt"), "nub 1999 1 10\nklan 1999 1 4\n")
    bi = _write(os.path.join(workdir, "bi.txt"), "the nut 1999 1 20\n")
    main(["substring-mean", uni, bi, os.path.join(workdir, "o5")], spark=spark)
    assert sorted(_read(os.path.join(workdir, "o5"))) == ["1999 | kla\t4.0", "1999 | nu\t15.0"]
    main(["volume-stddev", uni, bi, os.path.join(workdir, "o6")], spark=spark)
    assert len(_read(os.path.join(workdir, "o6"))) == 1


def test_clustering_jobs(spark, workdir, capsys):
    rows = ["a\t0\t0", "b\t0\t1", "c\t1\t0", "d\t10\t10", "e\t10\t11", "f\t11\t10"]
    data = _write(os.path.join(workdir, "data.tsv"), "\n".join(rows) + "\n")
    main(["moments", data, os.path.join(workdir, "mom")], spark=spark)
    mom = _read(os.path.join(workdir, "mom"))
    assert len(mom) == 2 and mom[0].split("\t")[0] == "NaN"
    cent = _write(os.path.join(workdir, "cent"), "0 0\n10 10\n")
    variables = _write(os.path.join(workdir, "vars"), "1 2 \n")
    main(["kmeans", data, cent, variables, os.path.join(workdir, "mom"), "20", os.path.join(workdir, "fit")], spark=spark)
    assert "after iteration" in capsys.readouterr().out
    assert len(_read(os.path.join(workdir, "fit"))) == 2
    main(["assign", data, os.path.join(workdir, "fit"), variables, os.path.join(workdir, "mom"), os.path.join(workdir, "asg")], spark=spark)
    got = dict(line.split("\t", 1)[::-1] for line in _read(os.path.join(workdir, "asg")))
    assert {got["a\t0\t0"], got["d\t10\t10"]} == {"0", "1"} and got["a\t0\t0"] == got["b\t0\t1"]
    main(["kmeans-raw", data, cent, variables, os.path.join(workdir, "fitraw")], spark=spark)
    assert _read(os.path.join(workdir, "fitraw"))[0].startswith("0.3333333333333333\t0.3333333333333333")


def test_cluster_job(spark, workdir):
    rows = ["\t".join([f"r{i}"] + [str((i * 7) % 13 + (20 if i % 2 else 0)) for _ in range(26)]) for i in range(40)]
    data = _write(os.path.join(workdir, "med.tsv"), "\n".join(rows) + "\n")
    main(["cluster", data, "2", "10", os.path.join(workdir, "mom"), os.path.join(workdir, "out")], spark=spark)
    assert len(_read(os.path.join(workdir, "mom"))) == 2
    assert len(_read(os.path.join(workdir, "out", "centroids"))) == 2
    assert len(_read(os.path.join(workdir, "out", "assigned"))) == 40


def test_cluster_job_on_a_headed_file_with_chosen_columns_and_given_moments(spark, workdir):
    body = ["\t".join([f"r{i}", str(i % 5 + (30 if i % 2 else 0)), str(i % 3), "text"]) for i in range(40)]
    data = _write(os.path.join(workdir, "headed.tsv"), "\n".join(["id\ta\tb\tc", *body]) + "\n")
    out, mom = os.path.join(workdir, "out"), os.path.join(workdir, "mom")
    main(["cluster", data, "2", "10", mom, out, "--header", "--vars", "2,3"], spark=spark)
    assert len(_read(os.path.join(out, "assigned"))) == 40
    assert _read(mom)[0].split("\t")[0] == "NaN"
    again = os.path.join(workdir, "again")
    main(["cluster", data, "2", "10", mom, again, "--header", "--vars", "2,3", "--given-moments"], spark=spark)
    assert sorted(_read(os.path.join(again, "assigned"))) == sorted(_read(os.path.join(out, "assigned")))


def test_jobs_that_prepare_the_clustering(spark, workdir):
    raw = _write(os.path.join(workdir, "raw.txt"), " a  1 2  \n b 3   4\n c 5 6\n")
    tabs, cut = os.path.join(workdir, "tabs"), os.path.join(workdir, "cut")
    main(["redelimit", raw, tabs], spark=spark)
    assert sorted(_read(tabs)) == ["a\t1\t2", "b\t3\t4", "c\t5\t6"]
    main(["cut", tabs, "1,3", cut], spark=spark)
    assert sorted(_read(cut)) == ["a\t2", "b\t4", "c\t6"]
    variables, start = _write(os.path.join(workdir, "v"), "1 2\n"), os.path.join(workdir, "start")
    main(["sample", tabs, "2", variables, start], spark=spark)
    assert len(_read(start)) == 2 and set(_read(start)) <= {"1.0\t2.0", "3.0\t4.0", "5.0\t6.0"}


def test_jobs_say_what_they_dropped(spark, workdir, capsys):
    recs = _write(os.path.join(workdir, "m.csv"), "0,t,Abba,1.5\n0,t,Abba,x\n0,t,Kiss,3.0\n")
    main(["range-max", recs, os.path.join(workdir, "o")], spark=spark)
    assert capsys.readouterr().out == "records: 3 read, 2 kept, 1 value is not a number, 0 no key\n"
    uni = _write(os.path.join(workdir, "uni.txt"), "nub 1999 1 10\nnub 1999 1 y\n")
    bi = _write(os.path.join(workdir, "bi.txt"), "the nut 1999 1 20\n")
    main(["volume-stddev", uni, bi, os.path.join(workdir, "s")], spark=spark)
    assert "unigrams: 2 read, 1 kept, 1 volumes are not an integer" in capsys.readouterr().out


def test_a_fit_goes_on_from_its_state(spark, workdir, capsys):
    rows = [f"r{i}\t{(i * 37) % 101}\t{(i * 53) % 89}" for i in range(200)]
    data = _write(os.path.join(workdir, "data.tsv"), "\n".join(rows) + "\n")
    mom, state = os.path.join(workdir, "mom"), f"file://{workdir}/state"
    run = lambda n, out, *more: main(["cluster", data, "4", str(n), mom, os.path.join(workdir, out), "--vars", "2,3", "--overwrite", "--seed", "7", *more], spark=spark)
    run(20, "whole")
    run(2, "part", "--state", state)
    run(20, "rest", "--state", state)
    whole, part, rest = capsys.readouterr().out.splitlines()
    assert whole == rest and "iteration 2;" in part
    assert _read(os.path.join(workdir, "whole", "centroids")) == _read(os.path.join(workdir, "rest", "centroids"))
    assert sorted(os.listdir(os.path.join(workdir, "state")))[:2] == ["round-000001", "round-000002"]
