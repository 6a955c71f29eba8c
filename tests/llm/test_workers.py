"""Functions that travel with a job load where the package is not installed."""

import os
import random
import subprocess
import sys

import public_tokenizers
import pytest
from pyspark import cloudpickle

from wastelake.llm import alignment, common, fingerprints, merkle, packing, pieces, quality, simhash, suffix_dedup, tokens

from .conftest import prose

LOAD = """
import pickle, sys
assert not any(p.rstrip('/') == {root!r} for p in sys.path)
for f in pickle.load(open(sys.argv[1], 'rb')):
    f()
assert 'wastelake.session' not in sys.modules
"""


def functions():
    text = prose(random.Random(1), 40)
    json_file, model = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return {
        "fingerprints": lambda: fingerprints.Sketcher().words(text),
        "tokens": lambda: tokens.counter(json_file).count(text),
        "packing": lambda: packing.Encoder(json_file).ids(text),
        "pieces": lambda: pieces.pieces_of(model).encode(text),
        "alignment": lambda: alignment.aligner(json_file, model).aligned(text),
        "merkle": lambda: merkle.Block.built(["0" * 64] * 9, 2).root(),
        "modules": lambda: [m.__name__ for m in (quality, simhash, suffix_dedup, common)],
    }


@pytest.mark.parametrize("name", sorted(functions()))
def test_functions_load_without_the_package(name, tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps([functions()[name]]))
    root = os.path.abspath(os.path.join(os.path.dirname(__file__), "..", ".."))
    run = subprocess.run([sys.executable, "-c", LOAD.format(root=root), str(tmp_path / "f")], cwd=tmp_path, capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin"})
    assert run.returncode == 0, run.stderr[-2000:]
