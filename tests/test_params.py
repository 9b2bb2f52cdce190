from types import SimpleNamespace

import pytest

from tokenweave.params import PackParams, check_divisible, check_seq_len, check_split


def test_split_check():
    assert check_split("val") == "val"
    with pytest.raises(ValueError):
        check_split("test")


def test_divisibility():
    assert check_divisible(524288, 8, 1024, 4) == 16
    assert check_divisible(524288, 8, 1024, 1) == 64
    with pytest.raises(ValueError):
        check_divisible(1000, 8, 1024, 4)


def test_seq_len():
    with pytest.raises(ValueError):
        check_seq_len(2048, 1024)


def test_params_defaults():
    p = PackParams().validate()
    assert p.BT == 1536 and p.accum_steps == 16 and p.unk_id == 19998 and p.eot_id == 19999
    with pytest.raises(ValueError, match="at most 65536"):
        PackParams(vocab_size=65_537).validate()
    with pytest.raises(ValueError, match="at most 65536"):
        PackParams(word_vocab_size=70_000).validate()
    with pytest.raises(ValueError):
        PackParams(total_batch=1000).validate()


def test_checkpoint_folder_must_be_named_off_local():
    from tokenweave.session import ensure_checkpoint_dir

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder)
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                             getConf=lambda: conf, setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=sc)

    for master in ("spark://h:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session(master))
        assert ensure_checkpoint_dir(session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(session("local[2]"))
