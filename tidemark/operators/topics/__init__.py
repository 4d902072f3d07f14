"""Topic modelling: corpus preparation, count tables, partitioned Gibbs sampling."""
