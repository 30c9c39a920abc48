"""Short-video log analytics and cache planning as Spark DataFrame jobs."""
