"""The registered queries as ANSI SQL over the same tables."""

from __future__ import annotations

_WITH = """
with tx as (
  select cast(event_id as varchar) id,
         case event_type when 'signup' then 1 when 'click' then 2 when 'view' then 3 when 'purchase' then 4 end
           transaction_type_id,
         cast(user_id as varchar) account_id, cast(user_id % 7 as varchar) bank_id, value amount_transferred,
         props reason, epoch_us(ts) // 1000 as ms, event_id
  from events where event_type <> 'error'),
fr as (
  select 'r' || event_id report_id, 'c' || (user_id % 5) fraud_chain_id, cast(event_id as varchar) transaction_id,
         cast(user_id as varchar) account_id, cast(user_id % 7 as varchar) bank_id,
         case when value >= 150 then 'CRITICAL' when value >= 75 then 'HIGH' when value >= 25 then 'MEDIUM'
              else 'LOW' end risk_level,
         epoch_us(ts) // 1000 as ms, event_id
  from events where event_type = 'error'),
dest as (
  select event_id, event_type, user_id, epoch_us(ts) // 1000 as ms,
         case when event_id % 97 = 0 then 'null_metadata' when event_id % 101 = 0 then 'unknown_type'
              when event_id % 103 = 0 then 'body_mismatch' end reject_reason,
         case when event_id % 97 = 0 or event_id % 101 = 0 or event_id % 103 = 0 then 'rejects'
              when event_type = 'error' then 'fraud-reports' else 'transactions' end topic,
         case when event_id % 97 = 0 then null when event_id % 101 = 0 then 'Refund'
              when (event_type = 'error') = (event_id % 103 = 0) then 'Transaction' else 'FraudReport' end sent_type,
         case when event_id % 89 = 0 then 'null_value' when event_id % 83 = 0 then 'bad_frame'
              when event_id % 79 = 0 then 'unknown_schema' when event_id % 73 = 0 then 'wrong_record'
              when event_id % 71 = 0 or event_id % 67 = 0 then 'decode_error' end decode_error
  from events)
"""

_TX = 'id, transaction_type_id, account_id, bank_id, amount_transferred, reason, ms as "timestamp"'
_FR = 'report_id, fraud_chain_id, transaction_id, account_id, bank_id, risk_level, ms as "timestamp"'

_BALANCES = _WITH + """
select account_id, round(sum(amount_transferred), 2) total_balance, make_timestamp_ms(max(ms)) last_updated
from tx group by account_id
"""


def _alerts(source: str, window_ms: int, count: int, amount: float, where: str = "true", watched: str = "",
            max_watched: int = 0) -> str:
    watched_count = f"cast(count(*) filter (where transaction_type_id in ({watched})) as int)" if watched else "0"
    return f"""
select account_id,
       case when n > {count} and s > {amount} then 3 when s > {amount} then 2 when n > {count} then 1 else 4 end type_id,
       case when n > {count} and s > {amount} then 'CRITICAL: High frequency (' || n ||
              ' transactions) and large total amount ($' || format('{{:,.2f}}', s) || ')'
            when s > {amount} then 'HIGH: Large total amount ($' || format('{{:,.2f}}', s) || ')'
            when n > {count} then 'MEDIUM: High frequency (' || n || ' transactions)'
            else 'MEDIUM: Suspicious transaction types (' || k || ' transactions)' end reason,
       case when n > {count} and s > {amount} then 4 when s > {amount} then 3 else 2 end urgency_level,
       ws window_start, ws + {window_ms} window_end, n transaction_count, round(s, 2) total_amount
from (select account_id, (ms // {window_ms}) * {window_ms} ws, cast(count(*) as int) n,
             sum(amount_transferred) s,
             {watched_count} k
      from {source} group by 1, 2)
where (n > {count} or s > {amount} or k > {max_watched}) and {where}
"""


_ORDERS = """
with o as (select cast(o_custkey as varchar) account_id, o_totalprice amount_transferred,
                  epoch_us(o_orderdate) // 1000 as ms from orders)
"""
_DAY, _HOUR = 86_400_000, 3_600_000
_PARTS_FROM = 1_704_067_200_000


def _sessions(where: str) -> str:
    return _WITH + f"""
select account_id, min(ms) session_start, max(ms) + {_HOUR} session_end, count(*) transaction_count,
       round(sum(amount_transferred), 2) total_amount
from (select *, sum(opens) over (partition by account_id order by ms, id) session from (
        select *, case when ms - lag(ms) over (partition by account_id order by ms, id) <= {_HOUR} then 0 else 1 end
                  opens from tx))
group by account_id, session
having {where}
"""


ORACLES: dict[str, str] = {
    "route_transactions": _WITH + f"select {_TX} from tx join dest using (event_id, ms) where topic = 'transactions'",
    "route_fraud_reports": _WITH + f"select {_FR} from fr join dest using (event_id, ms) where topic = 'fraud-reports'",
    "route_rejects": _WITH + "select event_id, reject_reason from dest where topic = 'rejects'",
    "route_counts": _WITH + "select topic, reject_reason, count(*) n from dest group by all",
    "route_stream": _WITH + """
        select event_id, topic, reject_reason, sent_type event_type, cast(user_id as varchar) account_id from dest""",
    "event_time": _WITH + "select event_id, ms from dest",
    "decode_counts": _WITH + "select decode_error, count(*) n from dest group by all",
    "decode_events": _WITH + """
        select sent_type event_type, case when event_type = 'error' then 'r' || event_id else cast(event_id as varchar)
               end id, ms as "timestamp" from dest where decode_error is null""",
    "router_messages": _WITH + """
        select case topic when 'rejects' then 'dead-letters' else topic end topic, reason, count(*) n
        from (select case when decode_error is null then topic else 'rejects' end topic,
                     coalesce(decode_error, reject_reason) reason from dest)
        group by all""",
    "router_transactions": _WITH + f"""
        select {_TX} from tx join dest using (event_id, ms) where topic = 'transactions' and decode_error is null""",
    "account_balances": _BALANCES,
    "account_balances_stream": _BALANCES,
    "account_balances_sql": _BALANCES,
    "account_balances_sql_stream": _BALANCES,
    "account_balance_messages": _WITH + """
        select cast(4 as bigint) key_schema, cast(5 as bigint) value_schema, account_id,
               round(sum(amount_transferred), 2) total_balance from tx group by account_id""",
    "account_history": _WITH + """
        select account_id, count(*) transaction_count, round(sum(amount_transferred), 2) total_amount,
               min(amount_transferred) min_amount, max(amount_transferred) max_amount,
               round(avg(amount_transferred), 9) avg_amount, round(stddev_samp(amount_transferred), 9) stddev_amount,
               min(ms) first_seen, max(ms) last_seen
        from tx group by account_id""",
    "fraud_windows": _WITH + """
        select account_id, (ms // 300000) * 300000 window_start, (ms // 300000) * 300000 + 300000 window_end,
               cast(count(*) as int) transaction_count, round(sum(amount_transferred), 2) total_amount
        from tx group by account_id, ms // 300000""",
    "fraud_alerts": _ORDERS + _alerts("o", 300_000, 10, 10000.0),
    "fraud_alerts_one_minute": _WITH + _alerts("tx", 60_000, 1, 150.0),
    "fraud_alerts_scaled": _WITH + _alerts("tx", _DAY, 4, 300.0),
    "fraud_alerts_by_type": _WITH + _alerts("tx", _DAY, 6, 400.0, watched="2, 4", max_watched=1),
    "fraud_alerts_stream": _WITH + _alerts("tx", _DAY, 4, 300.0,
                                           f"ws + {_DAY} <= (select max(ms) - 10000 from tx)"),
    "account_sessions": _sessions("true"),
    "account_sessions_stream": _sessions(f"max(ms) + {_HOUR} <= (select max(ms) - 10000 from tx)"),
    "reported_transactions": _WITH + """
        select report_id, cast(fr.event_id - 1 as varchar) transaction_id, risk_level, tx.account_id,
               amount_transferred, fr.ms - tx.ms lag_ms
        from fr left join tx on tx.event_id = fr.event_id - 1""",
    "reported_transactions_stream": _WITH + f"""
        select report_id, named transaction_id, risk_level, tx.account_id, amount_transferred, fr.ms - tx.ms lag_ms
        from (select *, cast(event_id - 1 as varchar) named from fr) fr
             left join tx on tx.event_id = fr.event_id - 1 and tx.ms between fr.ms - {_DAY} and fr.ms
        where tx.id is not null
           or fr.ms < (select least((select max(ms) from tx), (select max(ms) from fr)) - 10000)""",
    "activity_before_report": _WITH + f"""
        select report_id, fr.account_id, fr.ms reported_at, count(tx.id) transaction_count,
               round(coalesce(sum(amount_transferred), 0), 2) total_amount
        from fr left join tx on tx.account_id = fr.account_id and tx.ms between fr.ms - {_DAY} and fr.ms
        group by 1, 2, 3""",
    "account_balances_state": _BALANCES,
    "replayed_letters": _WITH + """
        select topic, case topic when 'fraud-reports' then 'r' else '' end || event_id id,
               cast(user_id as varchar) account_id
        from dest where decode_error = 'unknown_schema' and reject_reason is null""",
    "late_transactions": _WITH + f""",
        parted as (select *, (ms - {_PARTS_FROM}) // {5 * _DAY} + event_id % 3 part from tx),
        cut as (select part, max(max(ms)) over (order by part rows between unbounded preceding and 1 preceding)
                       - {2 * _DAY} cut_off from parted group by part)
        select id, account_id, dense_rank() over (order by part) - 1 batch_id,
               coalesce((ms // {_DAY} + 1) * {_DAY} <= cut_off, false) late
        from parted join cut using (part)""",
    "activity_before_report_stream": _WITH + f""",
        asked as (select *, ms // {_HOUR} * {_HOUR} own_slice from fr),
        cut as (select least((select max(ms) from tx), (select max(own_slice) - {_HOUR} from asked)) - 10000 w)
        select report_id, a.account_id, a.ms reported_at, count(tx.id) transaction_count,
               round(coalesce(sum(amount_transferred), 0), 2) total_amount
        from asked a left join tx on tx.account_id = a.account_id and tx.ms >= own_slice - {_DAY} and tx.ms < own_slice
        where own_slice < (select w from cut) - {_DAY}
        group by 1, 2, 3""",
    "fraud_chains": _WITH.replace("with tx", "with recursive tx", 1) + """,
        ties as (select distinct account_id, fraud_chain_id chain from fr),
        beside as (select distinct x.chain a, y.chain b from ties x join ties y using (account_id)),
        reached as (select a, b from beside union select r.a, n.b from reached r join beside n on n.a = r.b),
        tops as (select a chain, min(account_id) group_id from reached join ties on ties.chain = b group by a),
        grouped as (select account_id, min(group_id) group_id from ties join tops using (chain) group by account_id)
        select account_id, group_id, count(*) over (partition by group_id) accounts from grouped""",
    "account_profiles": _WITH + f"""
        select account_id, count(*) transaction_count, round(sum(amount_transferred), 2) total_amount,
               min(amount_transferred) min_amount, max(amount_transferred) max_amount
        from tx where ms >= {_PARTS_FROM} + 7 * {_DAY} and ms < {_PARTS_FROM} + 17 * {_DAY} group by account_id""",
    "route_with_new_schemas": _WITH + """
        select topic, count(*) n from (
            select case when coalesce(decode_error, 'unknown_schema') = 'unknown_schema' and topic <> 'rejects' then topic
                        when decode_error = 'unknown_schema' and event_id % 4 < 2 then null
                        else 'dead-letters' end topic from dest)
        where topic is not null group by topic""",
    "route_to_two_sinks": _WITH + """
        select 'topics' sink, event_id, topic, reject_reason from dest
        union all select 'rejects', event_id, topic, reject_reason from dest where reject_reason is not null""",
    "fraud_alerts_early": _WITH + _alerts("tx", _DAY, 4, 300.0),
    "alerts_with_last_report": _WITH + f""",
        found as (
            select account_id, (ms // {_DAY}) * {_DAY} window_start,
                   case when count(*) > 4 and sum(amount_transferred) > 300 then 4
                        when sum(amount_transferred) > 300 then 3 else 2 end urgency_level
            from tx group by 1, 2 having count(*) > 4 or sum(amount_transferred) > 300)
        select f.*, report_id last_report_id, risk_level last_risk_level, fr.ms last_reported_at
        from found f left join fr on fr.account_id = f.account_id and fr.ms <= f.window_start + {_DAY}
        qualify row_number() over (partition by f.account_id, f.window_start order by fr.ms desc, report_id desc) = 1""",
    "unusual_amounts": _WITH + """
        select id, account_id, ms as "timestamp", amount_transferred, earlier, round(usual, 6) usual, round(spread, 6) spread
        from (select *, count(*) over w earlier, avg(amount_transferred) over w usual,
                     stddev_samp(amount_transferred) over w spread from tx
              window w as (partition by account_id order by ms, id rows between unbounded preceding and 1 preceding))
        where earlier >= 5 and abs(amount_transferred - usual) > 3 * spread""",
    "account_balances_backfilled": _BALANCES,
}
