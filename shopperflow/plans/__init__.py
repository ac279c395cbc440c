"""Plan shapes that keep global operations (ranks, quantiles, running sums) distributed."""
