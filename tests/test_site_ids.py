"""Site ids: indexes of real sites, and properties of the grid over the whole globe."""

import numpy as np
import pytest

from orbitlake.functions import h3

# Longitude, latitude and index of sites, one in each of 36 base cells (24, 38 and 83 are pentagons).
SITES = (
    (-6.728809405191, 43.522388996929, "8f185b730891146"), (19.692521005412, 41.443953208569, "8f1ed41316b6600"), (-86.221395484308, 38.325112297185, "8f2668c6c80a08c"),
    (-120.87865161197, 37.668157528448, "8f28361a96dc2d4"), (-80.030832045227, 40.7320453052, "8f2a8450da19a93"), (51.048121201886, 36.717226385, "8f2cf119889b4a1"),
    (136.78619490777, 35.212800032047, "8f2e6046cc50282"), (130.11943357285, 33.258172431899, "8f30d972d96b01c"), (-8.513287493256, 39.480130527082, "8f3906d5875d421"),
    (89.825163080667, 24.682848455248, "8f3cf535a41e4e3"), (26.976800822412, 39.601899787657, "8f3f649a6060d83"), (105.851577681179, 29.042063133384, "8f40e4c0b08da68"),
    (-87.016582084261, 20.713428647258, "8f450a56edab6e3"), (-107.337748189113, 24.804003837402, "8f4802bb6371520"), (120.577127487293, 23.682393155124, "8f4ba21858e1c60"),
    (-66.510837335134, 18.105598170187, "8f4cc531681e8a0"), (43.017134382063, 14.779133672709, "8f52f499adacaad"), (11.572615191765, 3.927561970315, "8f58db4d98ae408"),
    (-61.71424184439, 16.321498305121, "8f5e5d9ae46041e"), (100.736934768799, 21.71325526502, "8f64924559189a8"), (-79.906005204197, 9.305096956587, "8f66a5ce520e2e8"),
    (122.331254668346, 11.476479423326, "8f68664e5accaa1"), (35.762680829306, 3.781233760949, "8f6a5965ad1ddb1"), (-92.935508228716, 18.024548480289, "8f6d20c609691b6"),
    (39.904699542962, -0.107760921646, "8f7a73850d50888"), (-40.407165913421, -11.153087791616, "8f81112e3b2a16e"), (9.588715153077, 4.125112640422, "8f82d2bae0e5249"),
    (-54.733273725587, -2.479701375193, "8f8a9c572303d8a"), (130.931078417395, -12.424364037517, "8f9451dad04e9b5"), (146.630288915376, -7.209904265532, "8f9c8eccbdb2ce9"),
    (114.661587509709, -28.806064849733, "8fa7006d420c78c"), (-40.34277003219, -20.216336903634, "8fa89529e6128a6"), (138.636943650187, -34.684222855041, "8fb9161241914c2"),
    (175.587502785652, -40.971901483286, "8fbb2b10c8f604a"), (153.185078331424, -30.077082569211, "8fbe1a442986d18"), (118.053513518137, -33.984685847065, "8fc9b3654499b9b"),
)


def globe(n=4000):
    z, a = np.linspace(-1, 1, n), np.arange(n) * 2.399963
    return np.degrees(np.arcsin(z)), np.degrees(a) % 360 - 180


def test_indexes_of_sites(spark):
    df = spark.createDataFrame([(*s[:2], s[2]) for s in SITES] + [(None, 1.0, None), (1.0, float("nan"), None), (float("inf"), 1.0, None)], "lon double, lat double, want string")
    got = df.select("want", h3.h3_cell(df["lat"], df["lon"]).alias("got")).collect()
    assert len(got) == len(SITES) + 3 and all(r["got"] == r["want"] for r in got)


def test_every_place_of_every_face_has_its_base_cell():
    centres, base, turn = h3._tables()
    assert np.allclose((centres**2).sum(axis=1), 1) and set(base.ravel().tolist()) == set(range(122)) and set(turn.ravel().tolist()) <= set(range(6))
    for n, (face, *ijk) in enumerate(h3.HOMES):
        assert base[face][tuple(ijk)] == n and turn[face][tuple(ijk)] == 0
    # numbers go from north to south: cells of the first base cells lie in the far north, those of the last in the far south
    lat, lon = globe()
    numbers = (h3.cells(lat, lon, 0) >> 45) & 127
    assert len(set(numbers.tolist())) == 122 and np.corrcoef(lat, numbers)[0, 1] < -0.98


@pytest.mark.parametrize("resolution", [0, 1, 2, 7, 8, 15])
def test_form_of_the_indexes(resolution):
    lat, lon = globe()
    c = h3.cells(lat, lon, resolution)
    digits = np.stack([(c >> 3 * (15 - r)) & 7 for r in range(1, 16)], axis=1)
    assert ((c >> 52) & 15 == resolution).all() and (c >> 59 == 1).all()
    assert (digits[:, resolution:] == 7).all() and (digits[:, :resolution] < 7).all()
    # pentagons have no cells in the direction of k
    inside = np.isin((c >> 45) & 127, list(h3.PENTAGONS))
    assert all(h3._leading(d[:resolution]) != h3.K for d in digits[inside])


def test_cells_have_the_size_of_their_resolution():
    # 5.9 million cells at resolution 6, 36.1 square kilometres on average: steps of a tenth of a cell change the index every ten steps or so
    lat = np.linspace(10, 11, 3000)
    c = h3.cells(lat, np.full(3000, 20.0), 6)
    changes = (np.diff(c) != 0).sum()
    assert 15 <= changes <= 40
    # every child's digits follow its parent's, but where the parent's edge is crossed
    parents = h3.cells(lat, np.full(3000, 20.0), 5)
    shared = 15 - 5
    assert ((c >> 3 * shared) & ((1 << 15) - 1) == (parents >> 3 * shared) & ((1 << 15) - 1)).mean() > 0.85
