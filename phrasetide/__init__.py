"""Topic alerts and vote analytics over streams of posts, written for Spark."""
