"""Competition analytics on Spark: leaderboard intake, handicaps, placings and season reports."""
