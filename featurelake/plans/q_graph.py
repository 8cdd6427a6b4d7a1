"""Queries for the correlation network and graph metrics."""

from __future__ import annotations

from featurelake.functions.columns import rounded
from featurelake.operators import graph as gr
from featurelake.operators import transform as tr
from featurelake.plans.catalog import query
from featurelake.sources import fixtures as fx

CORR_THRESHOLD = 0.3  # the threshold the reference's script passes (function default 0.5)


def _corr(spark, sf_dir):
    return gr.correlation_matrix(tr.engineer_features(fx.flowers(spark, sf_dir, balance=True)))


@query("corr_matrix")
def corr_matrix(spark, sf_dir):
    return rounded(_corr(spark, sf_dir), 6)


@query("corr_edges")
def corr_edges(spark, sf_dir):
    return rounded(gr.correlation_edges(_corr(spark, sf_dir), CORR_THRESHOLD), 6)


@query("graph_metrics")
def graph_metrics(spark, sf_dir):
    return gr.summary(fx.purchase_graph(spark, sf_dir))


@query("degree_centrality")
def degree_centrality(spark, sf_dir):
    return gr.degree_centrality(fx.purchase_graph(spark, sf_dir))


@query("clustering")
def clustering(spark, sf_dir):
    return rounded(gr.average_clustering(fx.purchase_graph(spark, sf_dir)), 9)


@query("connected_components")
def connected_components(spark, sf_dir):
    return gr.component_sizes(fx.purchase_links(spark, sf_dir))  # repeated links join nothing more


@query("order_components")
def order_components(spark, sf_dir):
    return gr.component_sizes(fx.order_graph(spark, sf_dir))
