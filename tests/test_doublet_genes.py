import pytest

from cellgrain.operators import doublets, normalize
from cellgrain.plans import catalogue

SF = "/root/testdata/sf0.001"


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["doublet_score", "doublet_valley", "doublet_neighbours", "preprocess_doublets"])
def test_doublets_are_scored_on_as_many_genes_as_published(spark, monkeypatch, name):
    """Few genes leave most cells without counts of any, so with a score of 0."""

    def asked(expr, cells, genes, n_top=2000, flavor="seurat_v3"):
        raise Asked(n_top)

    monkeypatch.setattr(normalize, "select_hvgs", asked)
    with pytest.raises(Asked) as e:
        catalogue.queries()[name](spark, SF)
    assert e.value.args == (2000,) and doublets.GENES == 2000
