from paperloom.llm import canonical


def test_every_swap_of_two_letters_is_found(spark):
    """Entries of one edit accept a swap of any two letters: on the border of their segments too."""
    words = {"model": "R1", "survey": "R2", "ANOVA": "R3", "Optics": "R4", "LiDAR": "R5", "激光学": "R6", "interview": "R7"}
    refs = spark.createDataFrame([(i, "f", w, None) for w, i in words.items()], "ref_id string, field_name string, canon string, canon_alt string")
    want = {}
    for w, i in words.items():
        for a in range(len(w)):
            for b in range(a + 1, len(w)):
                v = list(w)
                v[a], v[b] = v[b], v[a]
                want["".join(v)] = i
    assert want["mdoel"] == "R1" and want["suvrey"] == "R2"
    got = {r.value: r.ref_id for r in canonical.map_values(spark.createDataFrame([("f", v) for v in want], "field_name string, value string"), refs).collect()}
    assert {v: (got[v], i) for v, i in want.items() if got[v] != i} == {}


def test_long_entries_take_edits(spark):
    """An entry of any length is reached by edits."""
    entry = "a very long name of a discipline " * 6
    refs = spark.createDataFrame([("R1", "f", entry, None)], "ref_id string, field_name string, canon string, canon_alt string")
    values = {entry[:70] + "X" + entry[70:]: "R1", entry[:20] + entry[21:]: "R1", entry + "and more of it": "NONE"}
    got = {r.value: r.ref_id for r in canonical.map_values(spark.createDataFrame([("f", v) for v in values], "field_name string, value string"), refs).collect()}
    assert got == values
