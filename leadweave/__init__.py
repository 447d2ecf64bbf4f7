"""Company-record resolution and lead scoring as Spark DataFrame plans."""
