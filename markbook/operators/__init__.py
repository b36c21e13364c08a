"""DataFrame operators of the valuation: lots, anchors, prices, core, pivots."""
