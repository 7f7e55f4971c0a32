from lexcurate.functions.lexicons import FUSED_SPLITS, get_lexicon


def test_sizes_match_source_lists():
    lat, mul = get_lexicon("latin"), get_lexicon("multi")
    assert [len(lat.judgment), len(lat.order), len(lat.reasoning), len(lat.procedural)] == [11, 10, 25, 34]
    assert [len(mul.judgment), len(mul.order), len(mul.reasoning), len(mul.procedural)] == [37, 25, 145, 109]
    assert [len(set(mul.judgment)), len(set(mul.order)), len(set(mul.reasoning)), len(set(mul.procedural))] == \
        [36, 23, 143, 106]


def test_fused_entries_present_and_splittable():
    mul = get_lexicon("multi")
    every = mul.judgment + mul.order + mul.reasoning + mul.procedural
    for fused in FUSED_SPLITS:
        assert fused in every
    fixed = get_lexicon("multi", fix_fused=True)
    assert len(fixed.judgment) == 38 and "ತೀರ್ಪು" in fixed.judgment
    assert not any(f in fixed.procedural for f in FUSED_SPLITS)
