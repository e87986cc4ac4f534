"""Jobs and reports: the load job, parametrised reports, map layers."""
