"""Plan-level helpers: join strategy, contracts, staging and publish."""
