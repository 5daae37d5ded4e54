from types import SimpleNamespace

import pytest

from corvane import session


def stub(master, named=None):
    context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,512]"])
def test_scratch_needs_a_shared_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(stub(master))
    assert session.shared_folder(stub(master, "hdfs:///shared")) == "hdfs:///shared"


def test_a_local_session_gets_a_folder_of_its_own():
    assert "corvane-" in session.shared_folder(stub("local[4]"))
