"""DataFrame-in / DataFrame-out warehouse operators."""
