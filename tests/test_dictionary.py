import random

import pytest

from tests.helpers import rows
from trendframe.operators import dictionary as d
from trendframe.schemas import DDL_EVENT, DICTIONARY, DICTIONARY_STATE, ROUTINE_PARAMS
from trendframe.streaming import dictionary_stream

EVENT = "seq long, evento string, obj_tipo string, obj_nome string, param_nome string, param_tipo string, mensagem string"


def payload(kind, target, name):
    field = lambda tag, v: "" if v is None else f"<{tag}>{v}</{tag}>"
    return (
        "<EVENT_INSTANCE>" + field("EventType", kind) + "<PostTime>2024-01-01</PostTime>"
        + field("ObjectType", target) + field("ObjectName", name) + "</EVENT_INSTANCE>"
    )


def test_snapshot(spark):
    params = spark.createDataFrame(
        [
            ("dbo", "f", "FUNCTION", "@a", "int", 1),
            ("dbo", "p", "PROCEDURE", "@b", "float", 1),
            ("dbo", "g", "FUNCTION", None, "float", 0),
            ("sys", "h", "FUNCTION", "@c", "int", 1),
            ("dbo", "v", "VIEW", "@d", "int", 1),
        ],
        ROUTINE_PARAMS,
    )
    assert rows(d.dictionary_snapshot(params), "obj_nome") == [
        ("FUNCTION", "f", "@a", "int", "Mensagem para o parâmetro f.@a"),
        ("FUNCTION", "g", None, "float", None),
        ("PROCEDURE", "p", "@b", "float", "Mensagem para o parâmetro p.@b"),
    ]


def test_parse(spark):
    df = spark.createDataFrame(
        [
            (1, payload("CREATE_FUNCTION", "FUNCTION", "f")),
            (2, payload("DROP_PROCEDURE", "PROCEDURE", "p")),
            (3, payload("ALTER", "TABLE", "t")),
            (4, payload("CREATE_FUNCTION", "FUNCTION", None)),
            (5, None),
        ],
        DDL_EVENT,
    )
    assert rows(d.parse_events(df), "seq") == [
        (1, "CREATE", "FUNCTION", "f"), (2, "DROP", "PROCEDURE", "p"), (3, "ALTER", None, "t"),
        (4, "CREATE", "FUNCTION", None), (5, None, None, None),
    ]


def test_lookup(spark):
    events = spark.createDataFrame(
        [(1, "CREATE", "FUNCTION", "f"), (2, "CREATE", "FUNCTION", "g"), (3, "CREATE", None, "f"), (4, "CREATE", "FUNCTION", None)],
        "seq long, evento string, obj_tipo string, obj_nome string",
    )
    params = spark.createDataFrame(
        [("f", "@b", "int", 2), ("f", "@a", "float", 1)],
        "routine_name string, parameter_name string, data_type string, ordinal int",
    )
    first, second = ("@a", "float", "Mensagem para f.@a"), ("@b", "int", "Mensagem para f.@b")
    get = lambda mode: [
        (r.seq, r.param_nome, r.param_tipo, r.mensagem)
        for r in d.lookup_parameters(events, params, mode).orderBy("seq", "param_nome", "mensagem").collect()
    ]
    assert get("one") == [
        (1, *first), (2, None, None, "Mensagem para g."), (3, None, None, "Mensagem para f."), (4, None, None, None),
    ]
    assert [r for r in get("each") if r[0] == 1] == [(1, *first), (1, *second)]
    # An object of another type is not looked up and stays one event.
    assert [r for r in get("each") if r[0] == 3] == [(3, None, None, "Mensagem para f.")]
    with pytest.raises(ValueError, match="mode"):
        d.lookup_parameters(events, params, "all")


def values(name):
    return (name, "int", f"m {name}")


def fold(state, events, mode):
    """Events one after the other. ``state`` rows are (tipo, nome, values, created_seq)."""
    state = list(state)
    for seq, kind, tipo, nome, params in sorted(events, key=lambda e: e[0]):
        match = lambda r: None not in (tipo, nome) and (r[0], r[1]) == (tipo, nome)
        if kind == "CREATE":
            state += [(tipo, nome, p, seq) for p in params]
        elif kind == "DROP":
            state = [r for r in state if not match(r)]
        elif kind == "ALTER":
            hit = [r for r in state if match(r)]
            state = [r for r in state if not match(r)]
            if mode == "one":
                state += [(r[0], r[1], params[0], r[3]) for r in hit]
            else:
                state += [(tipo, nome, p, c) for c in {r[3] for r in hit} for p in params]
    return state


def random_history(rng, first, n, objects=6):
    out = []
    for i in range(n):
        tipo = rng.choice(["FUNCTION", "PROCEDURE", "FUNCTION", None])
        kind = rng.choice(["CREATE", "CREATE", "ALTER", "ALTER", "DROP", "RENAME"])
        params = [values(f"@{first + i}_{k}") for k in range(rng.randint(1, 3))]
        out.append((first + i, kind, tipo, rng.choice([f"o{k}" for k in range(objects)] + [None]), params))
    return out


def event_frame(spark, events, mode):
    data = [
        (seq, kind, tipo, nome, *p)
        for seq, kind, tipo, nome, params in events
        for p in (params[:1] if mode == "one" else params)
    ]
    return spark.createDataFrame(data, EVENT)


def snapshot_state(rng):
    return [
        (tipo, f"o{k}", values(f"@s{k}{j}"), None)
        for tipo in ("FUNCTION", "PROCEDURE") for k in range(6) for j in range(rng.randint(0, 2))
    ]


def flat(state):
    return sorted(((r[0], r[1], *r[2]) for r in state), key=repr)


@pytest.mark.parametrize("mode", ["each", "one"])
@pytest.mark.parametrize("seed", range(2))
def test_apply_against_a_sequential_fold(spark, mode, seed):
    rng = random.Random(seed)
    state = snapshot_state(rng)
    history = random_history(rng, 1, 40)
    if mode == "one":
        history = [(s, k, t, n, p[:1]) for s, k, t, n, p in history]
    frame = spark.createDataFrame([(a, b, *v, c) for a, b, v, c in state], DICTIONARY_STATE)
    # In one go, and in two batches.
    whole = d.dictionary_apply(frame, event_frame(spark, history, mode), mode)
    half = d.dictionary_apply(frame, event_frame(spark, history[:20], mode), mode)
    two = d.dictionary_apply(half, event_frame(spark, history[20:], mode), mode)
    want = flat(fold(state, history, mode))
    assert sorted(rows(d.dictionary(whole)), key=repr) == want
    assert sorted(rows(d.dictionary(two)), key=repr) == want


@pytest.mark.parametrize(
    "kinds, left",
    [
        (["CREATE", "ALTER", "DROP", "CREATE"], ["@4"]),
        (["ALTER", "CREATE"], ["@2"]),
        (["CREATE", "DROP"], []),
        (["CREATE", "CREATE", "ALTER"], ["@3", "@3"]),
        (["DROP", "CREATE"], ["@2"]),
    ],
)
def test_short_histories(spark, kinds, left):
    history = [(i, k, "FUNCTION", "a", [values(f"@{i}")]) for i, k in enumerate(kinds, 1)]
    empty = spark.createDataFrame([], DICTIONARY_STATE)
    out = d.dictionary_apply(empty, event_frame(spark, history, "each"))
    assert sorted(r.param_nome for r in out.collect()) == left


def test_stream_over_several_batches(spark, tmp_path):
    rng = random.Random(5)
    store, source = str(tmp_path / "store"), str(tmp_path / "events")
    state = snapshot_state(rng)
    history = random_history(rng, 1, 45)
    params = spark.createDataFrame(
        [(seq, nome, *p[:2], i) for seq, _, _, nome, ps in history for i, p in enumerate(ps)],
        "seq long, routine_name string, parameter_name string, data_type string, ordinal int",
    )
    dictionary_stream.initialise(
        spark.createDataFrame([(a, b, *v) for a, b, v, _ in state], DICTIONARY), store
    )
    want = list(state)
    for k in range(3):
        part = history[15 * k : 15 * k + 15]
        frame = spark.createDataFrame(
            [(s, payload(f"{kind}_X", tipo, nome)) for s, kind, tipo, nome, _ in part], DDL_EVENT
        )
        frame.coalesce(1).write.mode("append").parquet(source)
        raw = spark.readStream.schema(DDL_EVENT).parquet(source)
        dictionary_stream.start(raw, params, store, once=True).awaitTermination()
        # Parameters are looked up for objects of a known type only, by their name.
        seen = [
            (s, kind, tipo, nome,
             [(p[0], p[1], f"Mensagem para {nome}.{p[0]}") for p in ps] if tipo and nome
             else [(None, None, None if nome is None else f"Mensagem para {nome}.")])
            for s, kind, tipo, nome, ps in part
        ]
        want = fold(want, seen, "each")
        assert sorted(rows(dictionary_stream.current(spark, store)), key=repr) == flat(want)
    dictionary_stream.apply_batch(frame, 2, params, store)
    assert sorted(rows(dictionary_stream.current(spark, store)), key=repr) == flat(want)
    # Compacted, with the stream's position: no old event is read again.
    target = str(tmp_path / "compacted")
    dictionary_stream.compact(spark, store, target)
    dictionary_stream.start(raw, params, target, once=True, checkpoint=f"{store}/checkpoint").awaitTermination()
    assert not (tmp_path / "compacted" / "events").exists()
    assert sorted(rows(dictionary_stream.current(spark, target)), key=repr) == flat(want)


def test_the_first_of_repeated_nodes_counts(spark):
    twice = payload("CREATE_FUNCTION", "FUNCTION", "a").replace("</EVENT_INSTANCE>", "<ObjectName>b</ObjectName><EventType>DROP_X</EventType></EVENT_INSTANCE>")
    assert rows(d.parse_events(spark.createDataFrame([(1, twice)], DDL_EVENT))) == [(1, "CREATE", "FUNCTION", "a")]


def test_payloads_that_cannot_be_applied(spark):
    good = payload("CREATE_FUNCTION", "FUNCTION", "f")
    data = [
        (1, good), (2, good), (2, good), (2, good), (3, good[:40]), (4, "no xml"), (5, ""), (6, " \n"), (7, None), (7, None),
        (8, payload(None, "FUNCTION", "f")), (9, payload("CREATE_FUNCTION", "FUNCTION", None)), (10, payload("DROP_TABLE", "TABLE", "t")),
        (11, good.replace("FUNCTION<", "FUN&CTION<")), (12, "<EVENT_INSTANCE/>"), (13, good), (13, good.replace(">f<", ">g<")), (None, good),
    ]
    read = d.read_events(spark.createDataFrame(data, DDL_EVENT))
    bad = sorted(((r.seq, r.defect, r.n) for r in d.rejected_events(read).collect()), key=repr)
    assert bad == sorted(
        [(2, "repeated", 2), (3, "malformed", 1), (4, "malformed", 1), (5, "empty", 1), (6, "empty", 1), (7, "empty", 2),
         (8, "incomplete", 1), (11, "malformed", 1), (12, "incomplete", 1)], key=repr,
    )
    kept = sorted(rows(d.good_events(read)), key=repr)
    f = ("CREATE", "FUNCTION", "f")
    assert kept == sorted([(1, *f), (2, *f), (9, "CREATE", "FUNCTION", None), (10, "DROP", None, "t"), (13, *f), (13, "CREATE", "FUNCTION", "g"), (None, *f)], key=repr)
    # Nothing is lost: each payload is an event, or rejected as often as it came.
    assert len(kept) + sum(n for _, _, n in bad) == len(data)


def test_rejected_payloads_of_a_stream_are_kept_and_the_rest_applied(spark, tmp_path):
    store = str(tmp_path / "store")
    dictionary_stream.initialise(spark.createDataFrame([], DICTIONARY), store)
    params = spark.createDataFrame([], "routine_name string, parameter_name string, data_type string, ordinal int")
    good = payload("CREATE_FUNCTION", "FUNCTION", "f")
    batches = [[(1, good), (1, good), (2, good[:50])], [(3, None), (4, payload("CREATE_PROCEDURE", "PROCEDURE", "p"))]]
    for k, data in enumerate(batches):
        for _ in range(2):  # a replay rejects nothing twice
            dictionary_stream.apply_batch(spark.createDataFrame(data, DDL_EVENT), k, params, store)
    names = lambda: sorted(r.obj_nome for r in dictionary_stream.current(spark, store).collect())
    assert names() == ["f", "p"]
    bad = sorted((r.batch_id, r.seq, r.defect, r.n) for r in dictionary_stream.rejected(spark, store).collect())
    assert bad == [(0, 1, "repeated", 1), (0, 2, "malformed", 1), (1, 3, "empty", 1)]


def test_a_batch_that_comes_again_after_compaction(spark, tmp_path):
    """Applied but not ticked off, then compacted, then replayed: its rows are not created twice. One only begun is applied."""
    store, target = str(tmp_path / "store"), str(tmp_path / "compacted")
    dictionary_stream.initialise(spark.createDataFrame([], DICTIONARY), store)
    params = spark.createDataFrame([("f", "@a", "int", 1)], "routine_name string, parameter_name string, data_type string, ordinal int")
    frame = lambda seq, kind, name: spark.createDataFrame([(seq, payload(f"{kind}_FUNCTION", "FUNCTION", name))], DDL_EVENT)
    first, second = frame(1, "CREATE", "f"), frame(2, "CREATE", "g")
    dictionary_stream.apply_batch(first, 0, params, store)
    # The second batch writes its version, but does not get as far as the ledger.
    ledger, dictionary_stream.record = dictionary_stream.record, lambda *_: None
    try:
        dictionary_stream.apply_batch(second, 1, params, store)
    finally:
        dictionary_stream.record = ledger
    dictionary_stream.compact(spark, store, target)
    state = lambda: sorted((r.obj_nome, r.param_nome) for r in dictionary_stream.current(spark, target).collect())
    assert state() == [("f", "@a")]
    for _ in range(2):
        dictionary_stream.apply_batch(first, 0, params, target)
        assert state() == [("f", "@a")]
    for _ in range(2):
        dictionary_stream.apply_batch(second, 1, params, target)
        assert state() == [("f", "@a"), ("g", None)]
    again = str(tmp_path / "again")
    dictionary_stream.compact(spark, target, again)
    for k, batch in enumerate((first, second)):
        dictionary_stream.apply_batch(batch, k, params, again)
    assert sorted(r.obj_nome for r in dictionary_stream.current(spark, again).collect()) == ["f", "g"]
