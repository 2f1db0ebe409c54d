import io
import zipfile

from tramline.operators import combine, exports, feed_graph, reach, stops
from tramline.operators.feed_graph import build_feed_graph
from tramline.sources import graphs, gtfs
from tramline.streaming import feeds

FILES = {
    "gtfs/stops.txt": "stop_id, stop_name ,stop_lat,stop_lon,parent_station\na,Caf\xe9,45.0,-122.0,\nb,B,45.1,-122.0,\nz,Zero,0,0,\nn,None,,,\nc,C,45.2,-122.0,\nu,Unused,45.3,-122.0,\n",
    "gtfs/routes.txt": "route_id,route_short_name,route_long_name,route_color,route_type,agency_id\nr1,1,One, ff0000 ,2,\nr2,,Two,,3,ag\nr3,3,Three,,300,ag\n",
    "gtfs/trips.txt": "trip_id,route_id,service_id\nt1,r1,wk\nt2,r1,wk\nt3,r2,ex\nt4,r9,wk\nt5,r1,none\n",
    "gtfs/stop_times.txt": "trip_id,arrival_time,departure_time,stop_id\nt1,08:10:00,08:10:00,b\nt1,08:00:00,08:00:00,a\nt1,08:20:00,08:20:30,c\nt2,08:00:00,08:00:00,a\nt2,08:10:00,08:10:00,b\nt2,08:20:00,08:20:00,c\n"
    "t3,23:50:00,23:50:00,a\nt3,24:00:00,24:00:00,z\nt3,25:10:59,25:10:59,b\nt4,08:00:00,08:00:00,a\nt4,08:10:00,08:10:00,b\nt5,08:00:00,08:00:00,a\nt5,08:10:00,08:10:00,b\nt1,,,u\n",
    "gtfs/calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nwk,1,1,1,1,1,0,0,20240101,20240114\n",
    "gtfs/calendar_dates.txt": "service_id,date,exception_type\nex,20240106,1\nwk,20240101,2\n",
    "gtfs/agency.txt": "",
}


def write(path, members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, text in members.items():
            z.writestr(name, text.encode("latin-1"))
    path.write_bytes(data.getvalue())


def test_feeds_end_to_end(spark, tmp_path):
    (tmp_path / "feeds").mkdir()
    write(tmp_path / "feeds/one.zip", FILES)
    write(tmp_path / "feeds/two.zip", FILES | {"gtfs/stops.txt": FILES["gtfs/stops.txt"] + "x,Long,1,2,,extra\n"})
    write(tmp_path / "feeds/twice.zip", {"a/stops.txt": "stop_id\n", "b/stops.txt": "stop_id\n"})
    (tmp_path / "feeds/bad.zip").write_bytes(b"no archive")
    archives = gtfs.files(spark, f"file://{tmp_path}/feeds")
    assert sorted((r.feed_id, r.reason) for r in gtfs.all_failures(gtfs.feed_status(archives)).collect()) == [("bad", "bad zip file"), ("twice", "more than one stops.txt")]
    t = gtfs.read_feeds(spark, f"file://{tmp_path}/feeds")
    got = t["stops"].collect()
    assert {r.feed_id for r in got} == {"one"} and got[0].stop_name == "Caf\xe9" and got[0].parent_station is None  # two.zip's stops can't be read
    assert t["agency"].count() == 0 and t["trips"].count() == 10

    g = build_feed_graph(t)
    assert [(r.stop_id, r.original_id) for r in g.stops.orderBy("stop_id").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    journeys = sorted((r.line_id, r.stops, r.times_within_day, r.days) for r in g.journeys.collect())
    assert journeys == [(0, [0, 1, 2], [480, 490, 500], [0, 1, 2, 3, 4]), (1, [0, 1], [1430, 1510], [5])]
    assert [(r.name, r.color, r.type_id, r.agency_id) for r in g.lines.filter("feed_id = 'one'").orderBy("line_id").collect()] == [("1", "ff0000", 2, "one:default"), ("Two", "", 3, "one:ag"), ("3", "", 300, "one:ag")]

    both = combine.combine(g)
    combine.write_graph(both, f"{tmp_path}/combined")
    back = combine.read_graph(spark, f"{tmp_path}/combined")
    assert back.journeys.count() == 2 and combine.counts(back).first() == (3, 6, 2)
    near = reach.reachable_by_cell(back.stops, back.journeys)
    assert sorted((r.stop_id, r.minutes_used) for r in near.collect()) == [(0, 0), (1, 0), (2, 0)]
    own = spark.createDataFrame([(0, 0, [0, 1], [1, 2], [0]), (1, 0, [0, 9], [1, 2], [0])], "journey_id long, line_id int, stops array<int>, times_within_day array<int>, days array<int>")
    sub = reach.cell_subgraphs(near, back.stops, back.lines, own)
    assert sub[2].count() == 1 and sub[0].count() == 3

    message = graphs.graph_messages(g, "feed_id").filter("feed_id = 'one'").first().content
    (tmp_path / "graphs").mkdir()
    (tmp_path / "graphs/one.pb").write_bytes(message)
    (tmp_path / "graphs/graphs_all_1.pb").write_bytes(message)
    again = graphs.read_graph_files(spark, f"file://{tmp_path}/graphs")
    assert again.stops.filter("feed_id = 'one' and minutes_used is null").count() == 3 and again.stops.count() == 3
    assert sorted((r.line_id, r.stops) for r in again.journeys.collect()) == [(0, [0, 1, 2]), (1, [0, 1])]

    assert exports.export_points(g.stops, g.lines, g.journeys).filter("agency = 'one:ag'").count() == 2
    feature = exports.point_features(g.stops).filter("original_id = 'b'").first().feature
    assert feature == '{"type":"Feature","properties":{"stop_id":1,"name":"B","minutes_used":0},"geometry":{"type":"Point","coordinates":[-122.0,45.1]}}'
    places, where = stops.all_stops(t)
    assert places.count() == 5 and where.filter("idx is null").count() == 0
    assert stops.standardized_stops(t)[0].count() == 4


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in/one.zip", FILES)
    run = lambda: feeds.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(120)
    run()
    write(tmp_path / "in/three.zip", FILES)
    run()
    assert sorted((r.feed_id, r["count"]) for r in spark.read.parquet(f"{tmp_path}/out/stops").groupBy("feed_id").count().collect()) == [("one", 6), ("three", 6)]


def test_spec_and_components(spark, tmp_path):
    (tmp_path / "spec.json").write_text('{\n"feeds": [{"id": "x"}, {"id": "y"}]}')
    assert sorted(r.feed.id for r in gtfs.read_specs(spark, f"{tmp_path}/spec.json").collect()) == ["x", "y"]
    (tmp_path / "parts.json").write_text('{"components": [["a", "b"], ["c"]]}')
    assert sorted(tuple(r) for r in gtfs.read_components(spark, f"{tmp_path}/parts.json").collect()) == [(0, "a"), (0, "b"), (1, "c")]
    (tmp_path / "graph.json").write_text('{"stops": [{"stop_id": 0}], "lines": [], "journeys": [{"line_id": 1, "stops": [0, 1, 1], "times_within_day": [1, 2, 3], "days": [0]}]}')
    assert [tuple(r) for r in graphs.read_json_graph(spark, f"{tmp_path}/graph.json")["edges"].collect()] == [(0, 1, 1)]


def test_messages_in_parts(spark, monkeypatch):
    """A message is made and parsed in parts, and is the one that is made at once."""
    journeys = [("x", i % 7, [i, i + 1], [i, i + 5], [0, i % 3]) for i in range(3000)] + [("nowhere", 0, [1, 2], [1, 2], [0])]
    g = feed_graph.FeedGraph(
        spark.createDataFrame([("x", 0, "A", 1.0, 2.0, None), ("y", 0, "B", 1.0, 2.0, 5)], "feed_id string, stop_id int, name string, lat double, lon double, minutes_used int"),
        spark.createDataFrame([("x", 3, "L", "", 3, "a")], "feed_id string, line_id int, name string, color string, type_id int, agency_id string"),
        spark.createDataFrame(journeys, "feed_id string, line_id int, stops array<int>, times_within_day array<int>, days array<int>"),
    )
    made = {r.feed_id: bytes(r.content) for r in graphs.graph_messages(g, "feed_id").collect()}
    cut = list(graphs.pieces(made["x"] * 30))
    assert len(cut) > 1 and b"".join(cut) == made["x"] * 30 and all(graphs.parse(c)["journeys"] for c in cut)
    assert set(made) == {"x", "y"} and graphs.parse(made["y"])["stops"] == [{"stop_id": 0, "name": "B", "lat": 1.0, "lon": 2.0, "minutes_used": 5}]
    assert [tuple(j.values()) for j in graphs.parse(made["x"])["journeys"]] == sorted(j[1:] for j in journeys[:-1])
    monkeypatch.setattr(graphs, "PIECE", 100)
    assert graphs.parsed(graphs.graph_messages(g, "feed_id")).journeys.count() == 3000


def test_cells_of_journeys(spark):
    """A row per journey, with its cells; rows per cell and journey are made only when they are written."""
    reached = spark.createDataFrame([(45, -122, 0, 0), (45, -122, 2, 1), *((46, -122, i, i) for i in range(3))], "lat_floor int, lon_floor int, stop_id int, new_id int")
    journeys = spark.createDataFrame([(5, [0, 2, 0], [1, 2, 3], [0]), (6, [0, 1], [1, 2], [0]), (7, [0, 9], [1, 2], [0])], "line_id int, stops array<int>, times_within_day array<int>, days array<int>")
    a, b = 45 * 65536 - 122 + 32768, 46 * 65536 - 122 + 32768
    got = sorted((r.line_id, r.stops, r.cells, r.gaps) for r in reach.cells_of_journeys(reached, journeys).collect())
    assert got == [(5, [0, 2, 0], [a, b], [[0, 1, 0], [0, 0, 0]]), (6, [0, 1], [b], [[0, 0]])]
