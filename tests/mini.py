"""Small forum pages, one of each kind, written for these tests."""

PAGES = {
    "site_a/asp/page/topic/topic.asp_TOPIC_ID_7_FORUM_ID_3.html": """<a class="linkstopo" href="FORUM.asp?FORUM_ID=3">Anime</a>&nbsp;>&nbsp;Ol&aacute; mundo</font>
<a href="post.asp?method=Reply&TOPIC_ID=7&FORUM_ID=3&CAT_ID=1&Forum_Title=Anime&Topic_Title=Ol%E1+mundo">Responder</a>
<table><tr><td bgcolor="F8F8F8"><b><a href="pop_profile.asp?mode=display&id=42">Ana</a></b><small>Membro</small><small>Recife</small><small>120 Mensagens</small></td><td colspan="2"><a name="501"></a><font>Enviado em 05/03/2004 14:07:09</font><hr size=1>Primeira linha<br>segunda<p>Bye</p><a href="http://x.org/a#b">x</a><a href="#top">topo</a></td></tr>
<tr><td bgcolor="white">Visitante</td><td colspan="2"><a name="502"></a><font>Enviado em 06/03/2004</font><hr>De passagem</td></tr></table>""",
    "site_b/asp/page/topic/topic.asp_TOPIC_ID_7.html": """<table><tr><td bgcolor="F8F8F8"><b><a href="pop_profile.asp?mode=display&id=42">Ana</a></b></td><td colspan="2"><a name="501"></a><font>Enviado em 04/03/2004 10:00</font><hr>Outra captura</td></tr></table>""",
    "site_a/phpbb/page/viewtopic/viewtopic.php_t_9.html": """<td width="100%" class="nav"><a href="index.php">Home</a> &gt; <a href="viewforum.php?f=4">Geral</a></td><td class="maintitle">Assunto</td><a href="viewtopic.php?t=9">t</a>
<tr><td class="row1" rowspan="2"><strong>Bia</strong><span class="postdetails">Veterano<br />Mensagens: 33<br />Localização: Natal</span></td><td class="row1" valign="top"><a href="viewtopic.php?p=77#77">p</a><table><tr><td>Enviada: Mar 05, 2004 3:04 pm</td></tr><tr><td class="postbody"><hr />antes<table><tr><td class="quote">cita</td></tr></table>depois</td></tr><tr><td height="40" valign="bottom" class="genmed">_________________<br />Assinatura da Bia</td></tr></table></td></tr>
<tr><td class="row1" valign="bottom" nowrap="nowrap"><a href="profile.php?mode=viewprofile&amp;u=12">perfil</a></td></tr>""",
    "site_a/asp/page/post/post.asp_method_ReplyQuote.html": """<input name="TOPIC_ID" type="hidden" value="7"><input name="REPLY_ID" type="hidden" value="501"><input name="AUTHOR" type="hidden" value="42"><input name="FORUM_TITLE" type="hidden" value="Anime"><textarea name="Message">[quote][b]Oi[/b] [url=http://x.org]site[/url][/quote]</textarea>""",
    "site_a/asp/page/post/post.asp_same.html": """<input name="TOPIC_ID" type="hidden" value="7"><input name="REPLY_ID" type="hidden" value="502"><textarea name="Message">De passagem</textarea>""",
    "site_a/asp/page/post/post.asp_stub.html": """<input name="TOPIC_ID" type="hidden" value="99"><textarea name="Message"></textarea>""",
    "site_a/asp/page/profile/pop_profile.asp_mode_display_id_42.html": """<td valign=top align=left bgcolor="618F9E"><font><b>&nbsp;Ana</b></font></td><tr><td><b><font>Membro desde:&nbsp;</font></b></td><td><font>05/03/2004</font></td></tr><tr><td><b><font>Cidade:&nbsp;</font></b></td><td><font>Recife</font></td></tr><tr><td><b><font>Homepage:&nbsp;</font></b></td><td><font><a href="http://ana.org">a</a></font></td></tr>""",
    "site_a/phpbb/page/profile/profile.php_mode_viewprofile_u_12.html": """<th class="thHead" colspan="2">Exibir perfil :: Bia</th><tr><td>Registrado em:</td><td>05/03/2004</td></tr><tr><td>Interesses:</td><td>anime</td></tr>""",
    "site_a/asp/page/members/members.asp.html": """<tr><td><a href="pop_profile.asp?mode=display&id=42">i</a></td><td><a href="pop_profile.asp?mode=display&id=42">Ana</a></td><td>Membro</td><td>120</td><td>01/02/2005</td><td>05/03/2004</td><td>Recife</td></tr>""",
    "site_a/phpbb/page/memberlist/memberlist.php.html": """<tr><td class="row1"><span class="name"><a href="profile.php?mode=viewprofile&amp;u=12">Bia</a></span></td><td class="row1">05 Mar 2004</td><td class="row1">33</td><td class="row1"><a href="http://bia.org">w</a></td></tr><tr><td class="row1"><span class="name"><a href="profile.php?mode=viewprofile&amp;u=13">ANÁ</a></span></td><td class="row1">x</td><td class="row1">1</td><td class="row1">-</td></tr>""",
}
