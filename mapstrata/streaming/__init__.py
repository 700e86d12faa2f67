"""No streaming operators: layers are published as whole editions and loaded
by batch jobs.  See ``plans`` for these."""
