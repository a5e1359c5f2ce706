"""The registered queries: the library's operators on the test tables, each with its SQL check.

The tables play the roles of a race feed: an order is a session, a customer a driver, line items
are laps (returned ones pit stops) and events are positions, weather samples and messages.
"""
