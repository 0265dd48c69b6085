"""flocklens — attendance and membership analytics as Spark DataFrame jobs.

Two registries (a CRM of campaigns/campaign members and a ticketing platform's
events/attendees/orders) are turned into a star schema: date, event and member
dimensions, an attendance fact and a ticketing attendance table, with
attendance-risk profiling and cross-registry identity resolution on the way.

Every operator is a pure function ``(DataFrame..., Settings) -> DataFrame``; the
whole build is one lazily composed logical plan that Catalyst optimises.
"""

from flocklens.config import Settings

__all__ = ["Settings"]
