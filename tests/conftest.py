import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from estuary.session import survey_session
    s = survey_session("estuary-tests", master="local[4]", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="estuary-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="estuary-test-")


def haul(reference, **kw):
    """One physical-master row with defaults for every column."""
    row = dict(reference=reference, bay=reference[:2], type="M", year=int(reference[3:7]), month=5,
               zone="A", gear=20, stratum="A", Project_1="AM", Project_2=None, Project_3=None,
               startdepth=1.0, enddepth=0.5, wng_dpth=0.8, soakhr=1.0, soakmin=30.0, dist_tow=0.5,
               bottomvegcover="50", TotalShoreCover="40")
    row.update(kw)
    return row


def frame(spark, schema, rows):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


CODES = [
    ("BottomType", "M", "Mud", "Mud"), ("BottomType", "S", "Sand", "Sand"),
    ("BottomType", "U", "Unknown", "Unknown"), ("BottomType", "O", "Oyster", "Structure"),
    ("BottomVeg", "HA", "Halodule", "Seagrass"), ("BottomVeg", "TH", "Thalassia", "Seagrass"),
    ("BottomVeg", "RU", "Ruppia", "Seagrass"), ("BottomVeg", "SM", "Seagrasses: Mixed", "SAV"),
    ("BottomVeg", "AM", "Algae: Mixed", "Algae"), ("BottomVeg", "NO", "None", "None"),
    ("BottomVeg", "MX", "Mixed", "SAV"), ("BottomVeg", "HE", "Halophila englemanii (star grass)", "SAV"),
    ("ShoreType", "SW", "Seawall", "Manmade"), ("ShoreType", "MG", "Mangrove", "Terrestrial"),
    ("ShoreType", "OY", "Oyster bar", "Structure"), ("ShoreType", "SP", "Spartina", "Emergent"),
    ("ShoreType", "MA", "Marina", "Man-altered"),
]


@pytest.fixture
def codes(spark):
    from estuary.sources import schemas
    return spark.createDataFrame(CODES, schemas.CODES)
