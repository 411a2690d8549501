"""DataFrame-to-DataFrame building blocks shared by the jobs in ``opsflow.plans``."""
