from __future__ import annotations

from cartulary.cli import load, main
from cartulary.schemas import RECAP


def test_jobs_from_files(spark, tmp_path):
    base = tmp_path / "ref.csv"
    base.write_text("uuid,name,path,size,checksum_md5,unitid,corpus_code,last_content_modification_date,s3_uploaded\n" + "".join(f"u{i},n{i // 2},p,{i},c{i // 2},X_{i},PRA_{i % 2},{i}.0,{'True' if i == 9 else ''}\n" for i in range(10)))
    listing = tmp_path / "s3.csv"
    listing.write_text("key,last_modified,size,storage_class,uuid,checksum_md5,s3_bucket\nk1,2025-12-24 20:35:27+00:00,1,S,u1,c,b\n")

    def run(job, *rest):
        out = str(tmp_path / f"{job}.parquet")
        main([job, "--input", str(base), "--output", out, *rest], spark)
        return load(spark, out).collect()

    joined = {r.uuid: r for r in run("s3-join", "--listing", str(listing))}
    assert joined["u1"].s3_key == "k1" and joined["u1"].s3_uploaded_date == 20251224 and joined["u2"].s3_uploaded is False
    decided = {r.uuid: r.action for r in run("dedup")}
    assert len(decided) == 9 and decided["u1"] == "transférer" and decided["u0"] == "ne pas transférer"
    drawn = run("sample", "--codes", "PRA_", "--most-rows", "6")
    assert len(drawn) == 6 and len({r.corpus_code for r in drawn}) == 2
    pivot = {r.corpus_code: r for r in run("pivot", "--index", "corpus_code", "--values", "size", "--aggfunc", "sum", "median")}
    assert pivot["PRA_0"].size_sum == 20 and pivot["PRA_1"].size_median == 5
    rebuilt = run("rebuild", "--ref", str(base), "--year", "1971")
    assert isinstance(rebuilt, list)


def test_recaps_to_summary(spark, tmp_path):
    folder = tmp_path / "recaps"
    folder.mkdir()
    head = ",".join(f.name for f in RECAP)
    (folder / "a.csv").write_text(f"{head}\n/x/corpora/press/i.tif,tif,2097152,1,1,/o/i_jp2_q80.jp2,jp2,80,1048576,1,1\n/x/corpora/press/j.tif,tif,0,1,1,/o/j_jp2_q80.jp2,jp2,80,5,1,1\n")
    main(["concat", "--input", str(folder), "--output", str(tmp_path / "all.parquet")], spark)
    main(["summary", "--input", str(tmp_path / "all.parquet"), "--output", str(tmp_path / "sum.parquet"), "--marqueur", "corpora"], spark)
    r = load(spark, str(tmp_path / "sum.parquet")).collect()
    assert [(x.corpus, x.signature, x.n, x.mean_ratio, x.total_mib) for x in r] == [("press", "jp2_q80", 1, 2.0, 1.0)]


def test_file_jobs(spark, tmp_path):
    (tmp_path / "src" / "p").mkdir(parents=True)
    (tmp_path / "src" / "p" / "a.tif").write_bytes(b"12345")
    (tmp_path / "m.csv").write_text("corpus_code,name,path,s3_key\nMED_X,a.tif,p,\nMED_X,b.tif,p,\n")
    main(["transfer", "--input", str(tmp_path / "m.csv"), "--source", f"file://{tmp_path}/src", "--destination", f"file://{tmp_path}/dst", "--output", str(tmp_path / "log.parquet")], spark)
    assert {r.name: r.statut for r in load(spark, str(tmp_path / "log.parquet")).collect()} == {"a.tif": "copie", "b.tif": "absent"}
    main(["checksums", "--input", str(tmp_path / "dst"), "--output", str(tmp_path / "sums.parquet")], spark)
    assert [len(r.checksum_md5) for r in load(spark, str(tmp_path / "sums.parquet")).collect()] == [32]
    (tmp_path / "i.csv").write_text("corpus,width,height,dpi\nc,4000,100,300\n")
    main(["image-recap", "--input", str(tmp_path / "i.csv"), "--factor", "0.5", "--output", str(tmp_path / "recap.parquet")], spark)
    assert [(r.corpus, r.x_after, r.pixels_left) for r in load(spark, str(tmp_path / "recap.parquet")).collect()] == [("c", 2000, 25)]
