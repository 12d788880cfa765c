"""wattline: machine energy and production effectiveness on Spark."""
