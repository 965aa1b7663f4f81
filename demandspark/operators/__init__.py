"""Panel, feature, dataset, class, publishing and model operators."""
