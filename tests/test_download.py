import http.server
import json
import threading
from collections import Counter

import pytest

from spanloom.__main__ import main
from spanloom.plans.download import Sites, download
from spanloom.sources.http import bodies, probe
from tests.test_sources import write_bigwig


@pytest.fixture(scope="module")
def server(tmp_path_factory):
    folder = tmp_path_factory.mktemp("served")
    for k, name in enumerate(("enc", "gtex", "fwd", "rev", "atlas")):
        write_bigwig(folder / f"{name}.bw", {"chr1": 500 + k}, [(0, 1, 0, 0, [(0, 3, 1.5 + k)])], 1.0)
    files = {name: (folder / f"{name}.bw").read_bytes() for name in ("enc", "gtex", "fwd", "rev", "atlas")}
    asked: Counter = Counter()
    pages = {
        "/files/E1/?format=json": json.dumps({"file_format": "bigWig", "href": "/files/enc.bigWig"}),
        "/files/E2/?format=json": json.dumps({"file_format": "bed", "href": "/x"}),
        "/mirror/": '<a href="a.CNhs1.ctss.fwd.bw">x</a>', "/root/a/": '<a href="b.CNhs1.ctss.rev.bw">x</a><a href="b.CNhs1.ctss.fwd.bw">x</a>', "/root/b/": "<html></html>",
        "/atlas2/": '<A class="z" HREF="Cell_Two.bw">x</A><a href="Bad.bw">', "/atlas3/": '<a href="Cell+Two.bw">x</a>',
        "/manifest": "index\tidentifier\tfile\tclip\tclip_soft\tscale\tsum_stat\tstrand_pair\tdescription\n0\tA+\t/rna/encode/a\t1\t2\t3\tsum\t1\td\n1\tB\t/x\t1\t2\t3\tsum\t0\td\n",
        "/targets": "index\tidentifier\tfile\n0\tC1\t/x/atac/catlas/Cell_Two.bw\n1\tC2\t/x/atac/catlas/Bad.bw\nshort\n",
    }
    served = {
        "/files/enc.bigWig": files["enc"], "/r2/human/data_sources/gtex/base_sums/IN/BRAIN/-1/gtex.base_sums.BRAIN_S-1.2.ALL.bw": files["gtex"],
        "/mirror/a.CNhs1.ctss.fwd.bw": files["fwd"], "/root/a/b.CNhs1.ctss.rev.bw": files["rev"], "/root/a/b.CNhs1.ctss.fwd.bw": b"never asked",
        "/atlas2/Cell_Two.bw": b"not a BigWig " * 40, "/atlas3/Cell+Two.bw": files["atlas"], "/atlas2/Bad.bw": b"nor this " * 40,
    }

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            if self.path == "/mirror/" and asked[self.path] == 1:
                return self.send_error(503)
            body = pages[self.path].encode() if self.path in pages else served.get(self.path)
            if body is None:
                return self.send_error(404)
            span = self.headers.get("Range")
            if span and self.path in served and "enc" not in self.path:
                a, b = span.removeprefix("bytes=").split("-")
                part = body[int(a) : int(b) + 1]
                self.send_response(206)
                self.send_header("Content-Range", f"bytes {a}-{b}/{len(body)}")
                body = part
            else:
                self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    running = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}", files, asked
    running.shutdown()


def sites(base):
    return {"metadata": base, "base_sums": [f"{base}/r1", f"{base}/r2"], "tag_mirror": f"{base}/mirror/", "tag_root": f"{base}/root/", "tag_folders": ["a/", "b/"], "atlas": [f"{base}/atlas1/", f"{base}/atlas2/", f"{base}/atlas3/"], "targets": f"{base}/targets"}


TRACKS = [
    {"id": "E1", "provider": "ENCODE"}, {"id": "E2+", "provider": "ENCODE", "source": {"file_accession": "E2"}}, {"id": "S-1.2", "provider": "recount3/GTEx", "description": "RNA:brain"},
    {"id": "S-9.1", "provider": "recount3/GTEx", "description": "RNA:brain"}, {"id": "CNhs1+", "provider": "FANTOM5", "strand": "+"}, {"id": "CNhs1-", "provider": "FANTOM5", "strand": "-"},
    {"id": "CNhs2-", "provider": "FANTOM5", "strand": "-"}, {"id": "C1", "provider": "CATlas"}, {"id": "C2", "provider": "CATlas"}, {"id": "C3", "provider": "CATlas"}, {"id": "odd id", "provider": "odd"},
]


def test_download_command(spark, server, tmp_path):
    base, files, asked = server
    (tmp_path / "t.jsonl").write_text("".join(json.dumps(t) + "\n" for t in TRACKS))
    (tmp_path / "sites.json").write_text(json.dumps(sites(base)))
    args = [str(x) for x in ("download", "--tracks", tmp_path / "t.jsonl", "--output-dir", tmp_path / "raw", "--connections", 3, "--sites", tmp_path / "sites.json")]
    with pytest.raises(SystemExit) as ended:
        main(args, spark)
    assert ended.value.code == 2
    want = {"E1.bw": "enc", "S-1.2.bw": "gtex", "CNhs1+.bw": "fwd", "CNhs1-.bw": "rev", "C1.bw": "atlas"}
    assert {p.name: p.read_bytes() for p in (tmp_path / "raw").iterdir() if p.name.endswith(".bw")} == {n: files[f] for n, f in want.items()}
    assert not [p for p in (tmp_path / "raw").iterdir() if p.name.startswith(".parts")]
    report = [line.split("\t") for p in (tmp_path / "raw" / "download_failures").glob("part-*") for line in p.read_text().splitlines()[1:]]
    errors = {r[0]: r[2] for r in report}
    assert set(errors) == {"E2+", "S-9.1", "CNhs2-", "C2", "C3", "odd id"}
    assert "no bigWig link" in errors["E2+"] and "all candidate sources failed" in errors["C2"] and "no expected" in errors["C3"] and "unsupported" in errors["odd id"]
    assert asked["/root/a/b.CNhs1.ctss.fwd.bw"] == 0 and asked["/mirror/a.CNhs1.ctss.fwd.bw"] == 4 and asked["/mirror/"] == 2
    # The next run asks for what is missing alone; an empty manifest has no failure.
    before = asked["/files/enc.bigWig"]
    (tmp_path / "raw" / "C1.bw").write_bytes(b"broken")
    main([*args[:2], str(tmp_path / "one.jsonl"), *args[3:]], spark) if (tmp_path / "one.jsonl").write_text(json.dumps(TRACKS[0]) + "\n") else None
    assert asked["/files/enc.bigWig"] == before
    tracks = spark.read.schema(spark.read.json(str(tmp_path / "t.jsonl")).schema).json(str(tmp_path / "t.jsonl")).filter("id = 'C1'")
    again = Sites(**{k: tuple(v) if isinstance(v, list) else v for k, v in sites(base).items()})
    assert download(spark, tracks, str(tmp_path / "raw"), sites=again, deep_scan=True).count() == 0
    assert (tmp_path / "raw" / "C1.bw").read_bytes() == files["atlas"]


def test_a_manifest_behind_http(spark, server):
    from spanloom.sources.text import read_target_manifest

    base, _, _ = server
    assert [r["identifier"] for r in read_target_manifest(spark, f"{base}/manifest").collect()] == ["A+", "B"]
    with pytest.raises(ValueError, match="404"):
        read_target_manifest(spark, f"{base}/no-manifest")


def test_known_wrong_addresses_are_asked_once(spark, server):
    base, _, asked = server
    gone = spark.createDataFrame([(f"{base}/gone",), (f"{base}/gone",)], "url string")
    assert bodies(gone).first()["error"].endswith("404: Not Found") and asked["/gone"] == 1
    assert not probe(gone.limit(1)).first()["reachable"] and asked["/gone"] == 2
